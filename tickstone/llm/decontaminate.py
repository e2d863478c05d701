"""Benchmark decontamination: BM25 over the test items, asked by every passage.

The items are the indexed collection and each training passage is a query.  Weights
are divided by what an item scores for itself, so one threshold serves all items.
Pruning follows block-max WAND: items stand in blocks, and each term has its largest
weight overall and in each block.  A passage whose terms' largest weights do not reach
the threshold is left; then only blocks whose bounds reach it are looked into; only
their postings are scored.  All items above the threshold are retrieved, none is
dropped by rank.  A retrieved item counts as leaked when the passage also holds enough
of its question (shingles of five words) and of its answer (pairs of words).

Passages are twice as long as the longest item and overlap by half, so every stretch
of a text as long as an item lies whole in some passage.

The index is broadcast.  A benchmark above ``index_bytes`` of text is divided into
blocks of items below it, and the texts are read once for each.  Weights and passages
rest on the whole benchmark's counts, so results do not depend on the division.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scratch import materialise
from .common import released, text_chunks
from .substrings import Words

#: Share of an item's own score from which it is retrieved.
THRESHOLD = 0.5
#: Shares of the question's and the answer's shingles that a leak holds.
QUESTION, ANSWER = 0.5, 0.5
K1, B = 1.2, 0.75
#: Items in a block.
BLOCK = 32
#: Text of test items in one index at most.
INDEX_BYTES = 16 << 20
_SHORTEST = 32  # words of half a passage at least
_EXPANDED = 2_000_000  # postings in hand at once
_CHUNK = 2 << 20

# Letters, digits and everything beyond ASCII make words.
_GAPS = np.array([not (chr(i).isalnum() or i >= 128) for i in range(256)])


def _lower(texts: Sequence[bytes]) -> list[bytes]:
    return [t.decode("utf-8", "replace").lower().encode() for t in texts]


def question_and_answer(text: str) -> tuple[str, str]:
    """An item's two parts: cut at its last line break, else before its last sentence,
    else before its last quarter of words."""
    text = text.strip()
    head, _, tail = text.rpartition("\n")
    if not (head.strip() and tail.strip()):
        cut = max(text[:-1].rfind(mark) for mark in (". ", "? ", "! "))
        head, tail = (text[: cut + 1], text[cut + 1 :]) if cut > 0 else ("", "")
    if not (head.strip() and tail.strip()):
        words = text.split()
        k = len(words) - max(1, len(words) // 4)
        head, tail = " ".join(words[:k]), " ".join(words[k:])
    return head, tail


def _shingles(words: Words, i: int, size: int) -> np.ndarray:
    """Hashes of text ``i``'s shingles; a shorter text is one shingle."""
    a, b = words.first[i], words.first[i + 1]
    if a == b:
        return np.zeros(0, dtype=np.uint64)
    size = min(size, b - a)
    return np.unique(words.hash(np.arange(a, b - size + 1), size))


@dataclass(frozen=True)
class Index:
    items: list  # ids
    terms: np.ndarray  # sorted hashes
    most: np.ndarray  # largest weight of each term
    block_at: np.ndarray  # postings of term t: block_at[t] to block_at[t + 1]
    block: np.ndarray
    block_most: np.ndarray
    item_at: np.ndarray
    item: np.ndarray
    weight: np.ndarray
    question: list[np.ndarray]
    answer: list[np.ndarray]
    question_size: list[int]  # in words
    answer_size: list[int]
    half: int  # words of half a passage


@dataclass(frozen=True)
class Whole:
    """Figures of a whole benchmark of which an index holds a block."""

    n: int  # items
    mean: float  # words of an item that has any
    longest: int
    terms: np.ndarray  # sorted hashes of the block's terms
    df: np.ndarray  # items of the benchmark that have each


def build(items: Sequence[tuple[object, str]], whole: Whole | None = None) -> Index | None:
    """The index of (id, text) pairs; items without a word are left out.  Without
    ``whole`` they are the benchmark."""
    items = sorted(((i, t) for i, t in items if t), key=lambda x: (str(type(x[0])), x[0], x[1]))
    words = Words(_lower([t.encode() for _, t in items]), gaps=_GAPS)
    size = np.diff(words.first)
    if not len(items) or not size.any():
        return None
    pair, tf = np.unique(
        np.stack([words.each[0], words.text.astype(np.uint64)], axis=1), axis=0, return_counts=True
    )
    terms, term = np.unique(pair[:, 0], return_inverse=True)
    item = pair[:, 1].astype(np.int64)
    n = len(items)
    if whole is None:
        df = np.bincount(term, minlength=len(terms))
        whole = Whole(n, float(size[size > 0].mean()), int(size.max()), terms, df)
    df = whole.df[np.searchsorted(whole.terms, terms)]
    idf = np.log1p((whole.n - df + 0.5) / (df + 0.5))
    length = size / max(whole.mean, 1)
    weight = idf[term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length[item]))
    own = np.bincount(item, weight, minlength=n)
    weight = weight / own[item]
    block = item // BLOCK
    key, where = np.unique(term * (n // BLOCK + 1) + block, return_inverse=True)
    block_most = np.zeros(len(key))
    np.maximum.at(block_most, where, weight)
    most = np.zeros(len(terms))
    np.maximum.at(most, term, weight)
    of_term = key // (n // BLOCK + 1)
    at = np.arange(len(terms) + 1)
    parts = [question_and_answer(t) for _, t in items]
    asked = Words(_lower([q.encode() for q, _ in parts]), gaps=_GAPS)
    said = Words(_lower([a.encode() for _, a in parts]), gaps=_GAPS)
    return Index(
        [i for i, _ in items], terms, most, np.searchsorted(of_term, at), key % (n // BLOCK + 1),
        block_most, np.searchsorted(term, at), item, weight,
        [_shingles(asked, i, 5) for i in range(n)], [_shingles(said, i, 2) for i in range(n)],
        np.diff(asked.first).tolist(), np.diff(said.first).tolist(), max(_SHORTEST, whole.longest),
    )


def _expand(at: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Postings of each row's term: (row number, posting)."""
    size = at[rows + 1] - at[rows]
    row = np.repeat(np.arange(len(rows)), size)
    return row, np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size) + at[rows][row]


def _sums(key: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys, where = np.unique(key, return_inverse=True)
    return keys, np.bincount(where, value, minlength=len(keys))


def retrieve(x: Index, passage: np.ndarray, term: np.ndarray) -> tuple[np.ndarray, ...]:
    """(passage, item, score) of all above the threshold, from different (passage, term)
    pairs sorted by passage."""
    out: list[tuple] = []
    reach = THRESHOLD * (1 - 1e-9)  # bounds may round below what they bound
    n_blocks, n_items = len(x.items) // BLOCK + 1, len(x.items)
    cost = np.cumsum(x.item_at[term + 1] - x.item_at[term])
    start = 0
    while start < len(passage):
        stop = int(np.searchsorted(cost, (cost[start - 1] if start else 0) + _EXPANDED, "right"))
        stop = int(np.searchsorted(passage, passage[max(stop - 1, start)], "right" if stop <= start else "left"))
        stop = stop if stop > start else int(np.searchsorted(passage, passage[start], "right"))
        p, t = passage[start:stop], term[start:stop]
        start = stop
        row, at = _expand(x.block_at, t)
        key, bound = _sums(p[row] * n_blocks + x.block[at], x.block_most[at])
        key = key[bound >= reach]
        if not len(key):
            continue
        live = np.isin(p, key // n_blocks)
        p, t = p[live], t[live]
        row, at = _expand(x.item_at, t)
        inside = np.isin(p[row] * n_blocks + x.item[at] // BLOCK, key)
        row, at = row[inside], at[inside]
        key, score = _sums(p[row] * n_items + x.item[at], x.weight[at])
        good = score >= reach
        out.append((key[good] // n_items, key[good] % n_items, score[good]))
    if not out:
        none = np.zeros(0, dtype=np.int64)
        return none, none, none.astype(float)
    return tuple(np.concatenate(part) for part in zip(*out, strict=True))


def leaks(x: Index, texts: Sequence[bytes]) -> list[tuple[int, int, float, float, float]]:
    """(text, item, score, question share, answer share), the best passage of each pair."""
    words = Words(_lower(texts), gaps=_GAPS)
    n = len(words.start)
    if not n:
        return []
    each = words.each[0]
    at = np.minimum(np.searchsorted(x.terms, each), len(x.terms) - 1)
    known = x.terms[at] == each
    # Half passages in a row; a passage is one and the next of the same text.
    place = np.arange(n) - words.first[words.text]
    new = (place % x.half) == 0
    half = np.cumsum(new) - 1
    first = np.flatnonzero(new)
    text = words.text[first]
    bound = np.bincount(half, np.where(known, x.most[at], 0.0), minlength=len(first))
    follows = np.concatenate([text[1:] == text[:-1], [False]])
    both = bound + np.where(follows, np.concatenate([bound[1:], [0.0]]), 0.0)
    alone = ~follows & np.concatenate([[True], text[1:] != text[:-1]])
    asked = np.flatnonzero((both >= THRESHOLD * (1 - 1e-9)) & (follows | alone))
    if not len(asked):
        return []
    ends = np.concatenate([first[1:], [n]])
    last = np.where(follows[asked], np.minimum(asked + 1, len(first) - 1), asked)
    lo, hi = first[asked], ends[last]
    size = hi - lo
    passage = np.repeat(np.arange(len(asked)), size)
    token = np.arange(len(passage)) - np.repeat(np.cumsum(size) - size, size) + lo[passage]
    seen = known[token]
    pairs = np.unique(passage[seen] * len(x.terms) + at[token[seen]])
    found: dict[tuple[int, int], tuple] = {}
    grams: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    hits = sorted(zip(*(c.tolist() for c in retrieve(x, pairs // len(x.terms), pairs % len(x.terms))), strict=True))
    for p, item, score in hits:
        if p not in grams:
            grams = {p: (
                words.hash(np.arange(lo[p], max(lo[p], hi[p] - 4)), 5),
                words.hash(np.arange(lo[p], max(lo[p], hi[p] - 1)), 2),
            )}
        question = _share(x.question[item], words, lo[p], hi[p], 5, x.question_size[item], grams[p][0])
        answer = _share(x.answer[item], words, lo[p], hi[p], 2, x.answer_size[item], grams[p][1])
        if question >= QUESTION and answer >= ANSWER:
            key = int(text[asked[p]]), item
            if key not in found or (score, question, answer) > found[key]:
                found[key] = score, question, answer
    return [(*k, *v) for k, v in sorted(found.items())]


def _share(wanted, words: Words, lo: int, hi: int, usual: int, size: int, common) -> float:
    """Share of the wanted shingles found between two words; 1 if none is wanted."""
    if not len(wanted):
        return 1.0
    if size < usual:  # the whole part is one shorter shingle
        common = words.hash(np.arange(lo, max(lo, hi - size + 1)), size)
    return float(np.isin(wanted, common).mean())


def _sizes(items: DataFrame) -> tuple[int, float, int]:
    """Number of items, mean words of those that have any, words of the longest."""

    def work(batches):
        for _, texts in text_chunks(batches, "t", _CHUNK):
            size = np.diff(Words(_lower(texts), gaps=_GAPS).first)
            yield pa.RecordBatch.from_arrays([pa.array(size.astype(np.int64))], ["size"])

    found = items.select("t").mapInArrow(released(work), "size bigint").agg(
        F.count("size").alias("n"), F.avg(F.when(F.col("size") > 0, F.col("size"))).alias("mean"),
        F.max("size").alias("longest"),
    ).first()
    return found["n"], found["mean"] or 0.0, found["longest"] or 0


def _frequencies(items: DataFrame) -> DataFrame:
    """``block, term, df``: the terms of each block, with the items of all blocks that
    have the term."""

    def work(batches):
        for batch, texts in text_chunks(batches, "t", _CHUNK):
            words = Words(_lower(texts), gaps=_GAPS)
            block = batch.column(0).to_numpy().astype(np.uint64)
            pair = np.unique(np.stack([words.text.astype(np.uint64), words.each[0]], axis=1), axis=0)
            pair[:, 0] = block[pair[:, 0].astype(np.int64)]
            pair, n = np.unique(pair, axis=0, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(pair[:, 0].astype(np.int64)), pa.array(pair[:, 1].copy().view(np.int64)), pa.array(n)],
                ["block", "term", "df"],
            )

    each = items.select("block", "t").mapInArrow(released(work), "block bigint, term bigint, df bigint")
    each = materialise(each.groupBy("block", "term").agg(F.sum("df").alias("df")))
    whole = each.groupBy("term").agg(F.sum("df").alias("df"))  # of at most a row per block
    return materialise(each.select("block", "term").join(whole, "term").select("block", "term", "df"))


def _indexes(benchmark: DataFrame, item_id: str, text: str, index_bytes: int):
    """Indexes of all items, one for each block of items below ``index_bytes``."""
    items = benchmark.select(F.col(item_id).alias("i"), F.col(text).alias("t")).filter("t <> ''")
    total = items.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    blocks = -(-total * 5 // (index_bytes * 4)) or 1  # room for uneven blocks
    items = items.withColumn("block", F.pmod(F.xxhash64("i", "t"), F.lit(blocks)))
    if blocks > 1:
        sizes, frequencies = _sizes(items), _frequencies(items)
    for k in range(blocks):
        whole = None
        if blocks > 1:
            known = frequencies.filter(F.col("block") == k).toArrow()  # terms of one index
            terms, df = known["term"].to_numpy().view(np.uint64), known["df"].to_numpy()
            order = np.argsort(terms)
            whole = Whole(*sizes, terms[order], df[order])
        part = items.filter(F.col("block") == k)
        index = build([(r["i"], r["t"]) for r in part.collect()], whole)  # below index_bytes
        if index is not None:
            yield index


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text",
    item_id: str = "item_id", item_text: str = "text", index_bytes: int = INDEX_BYTES,
) -> DataFrame:
    """``doc_id, item_id, score, question_share, answer_share`` of every leak.

    One row per document row and leaked item.  Null and empty texts leak nothing;
    null and wordless items are in no text; equal items are each reported.
    """
    spark = docs.sparkSession
    item_type = dict(benchmark.dtypes)[item_id]
    arrow = pa.int64() if item_type in ("bigint", "int") else pa.string()
    schema = f"doc_id {dict(docs.dtypes)[doc_id]}, item_id {'bigint' if arrow == pa.int64() else 'string'}, "
    schema += "score double, question_share double, answer_share double"
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("_text"))
    out = None
    for index in _indexes(benchmark, item_id, item_text, index_bytes):
        shared = spark.sparkContext.broadcast(index)

        def work(batches, shared=shared):
            x = shared.value
            for batch, texts in text_chunks(batches, "_text", _CHUNK):
                found = leaks(x, texts)
                t, i, *rest = zip(*found, strict=True) if found else ((), (), (), (), ())
                names = [x.items[k] if arrow == pa.int64() else str(x.items[k]) for k in i]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(t, pa.int64())), pa.array(names, arrow)]
                    + [pa.array(r, pa.float64()) for r in rest],
                    ["doc_id", "item_id", "score", "question_share", "answer_share"],
                )

        part = rows.mapInArrow(released(work), schema)
        out = part if out is None else out.union(part)
    return spark.createDataFrame([], schema) if out is None else out


def without_leaks(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id",
    item_text: str = "text", index_bytes: int = INDEX_BYTES, chunk: int = 1 << 20,
) -> DataFrame:
    """The rows of ``docs`` in whose text no item leaked, unchanged and unshuffled.

    A task searches ``chunk`` bytes of texts at once, fewer than :func:`find_leaks`, as it
    also holds the rows it hands on.  Null and empty texts leak nothing.
    """
    spark = docs.sparkSession
    for index in _indexes(benchmark, item_id, item_text, index_bytes):
        shared = spark.sparkContext.broadcast(index)

        def work(batches, shared=shared):
            for batch, texts in text_chunks(batches, text, chunk):
                gone = {f[0] for f in leaks(shared.value, texts)}
                yield batch.filter(pa.array([i not in gone for i in range(len(texts))]))

        docs = docs.mapInArrow(released(work), docs.schema)
    return docs
