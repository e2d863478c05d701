"""Removal of word sequences that occur more than once, by prefix-partitioned suffix trees.

The suffixes of all texts are dealt into groups by a prefix of variable length, and
each group's subtree is built by itself.

*Which prefix.*  Of the 28 eight-word grams inside a window of 35 words, the one of
least hash is the window's anchor; equal windows have equal anchors at equal places.
The suffix that starts a window belongs to the prefix that ends with its anchor, 8 to
35 words long.  An anchor found once cannot lie in a repeated window, so only suffixes
of repeated anchors leave the task that read them, as runs of neighbouring windows.

*Memory-sized groups.*  An anchor of at most ``group_size`` occurrences is one group.
A more frequent anchor has its prefixes lengthened to the whole window: a group of
such a prefix holds equal windows only and its size is all there is to know, which
Spark counts from partial sums.

*Subtrees.*  Refined top-down, without nodes or edges being stored: suffixes are split
by the hashes of their first 12, 23 and 35 words, those alone in their part are dropped,
and the parts left at 35 words are what lies below the deep internal nodes.  On either
path, neighbouring windows that repeat join into one range of their text, as long as it
goes, and the words these ranges cover are removed.

The anchors to keep are passed to the tasks as two bit tables (repeated, and frequent),
with sixteen bits for each repeated anchor up to ``MOST_BITS``.  A bit set by chance costs
work and changes no result.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scratch import materialise
from .common import beside, carried, released, row_schema, salted_lookup, text_chunks

WINDOW = 35
GRAM = 8
#: Occurrences of an anchor up to which they form one group.
GROUP_SIZE = 20_000
#: Size of each bit table, at least and at the most; it is broadcast.
LEAST_BITS, MOST_BITS = 1 << 20, 1 << 30
_CHUNK = 1 << 20
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


class _Hash:
    """Polynomial hashes of all runs of a sequence, modulo 2**64."""

    def __init__(self, seed: int):
        rng = np.random.default_rng(seed)
        self.letters = rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.base = rng.integers(0, 1 << 60, 1, dtype=np.uint64) * np.uint64(8) + np.uint64(5)
        self.inverse = np.array([pow(int(self.base[0]), -1, 1 << 64)], dtype=np.uint64)
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def powers(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up))
            one = np.ones(1, dtype=np.uint64)
            self.up = np.multiply.accumulate(np.concatenate([one, np.repeat(self.base, size - 1)]))
            self.down = np.multiply.accumulate(np.concatenate([one, np.repeat(self.inverse, size - 1)]))
        return self.up, self.down

    def sums(self, values: np.ndarray) -> np.ndarray:
        up, _ = self.powers(len(values) + 1)
        out = np.zeros(len(values) + 1, dtype=np.uint64)
        np.cumsum(values * up[: len(values)], out=out[1:])
        return out

    def runs(self, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((sums[end] - sums[start]) * self.powers(len(sums))[1][start])


def mix(h: np.ndarray) -> np.ndarray:
    """Spread a hash over all its bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_HASHES: dict[int, _Hash] = {}


def _hash(seed: int) -> _Hash:
    return _HASHES.setdefault(seed, _Hash(seed))


class Words:
    """The words of some texts in a row: where each starts and ends in ``raw``, the
    text it belongs to and running hashes over whole words."""

    def __init__(
        self, texts: Sequence[bytes], seeds: Sequence[int] = (1,), gaps: np.ndarray = _SPACE
    ):
        self.raw = b" ".join(texts) + b" "
        data = np.frombuffer(self.raw, np.uint8)
        space = gaps[data]
        edge = np.diff(space.view(np.int8), prepend=1)
        self.start, self.end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        ends = np.cumsum([len(t) + 1 for t in texts]) if texts else np.zeros(0, dtype=np.int64)
        self.text = np.searchsorted(ends, self.start, "right")
        self.first = np.searchsorted(self.text, np.arange(len(texts) + 1))  # first word of each text
        self.hashes = [_hash(s) for s in seeds]
        self.each, self.sums = [], []
        for h in self.hashes:
            sums = h.sums(h.letters[data])
            self.each.append(h.runs(sums, self.start, self.end))
            self.sums.append(h.sums(self.each[-1]))

    def windows(self, size: int) -> np.ndarray:
        """Starts of all windows of ``size`` words inside one text."""
        at = np.arange(max(0, len(self.start) - size + 1))
        return at[self.text[at] == self.text[at + size - 1]]

    def hash(self, at: np.ndarray, size: int, k: int = 0) -> np.ndarray:
        return self.hashes[k].runs(self.sums[k], at, at + size)


def _sliding(values: np.ndarray, size: int, least: bool) -> np.ndarray:
    """Minimum or maximum of each run of ``size`` values."""
    pick = np.minimum if least else np.maximum
    width, out = 1, values
    while 2 * width <= size:
        out = pick(out[:-width], out[width:])
        width *= 2
    rest = size - width
    return pick(out[: len(out) - rest], out[rest:]) if rest else out


def anchors(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word index and hash of each anchor, and the first and last window it stands for.

    Of equal least grams in a window the leftmost is its anchor, so every window has
    one, and equal windows have theirs at the same place.
    """
    n = len(words.start)
    if n < WINDOW:
        none = np.zeros(0, dtype=np.int64)
        return none, none.astype(np.uint64), none, none
    grams = WINDOW - GRAM + 1  # in a window
    h = words.hash(np.arange(n - GRAM + 1), GRAM) | np.uint64(1)
    least = _sliding(h, grams, True)  # by window
    valid = words.text[: n - WINDOW + 1] == words.text[WINDOW - 1 :]
    least[~valid] = 0
    padded = np.concatenate([np.zeros(grams - 1, dtype=np.uint64), least, np.zeros(grams - 1, dtype=np.uint64)])
    at = np.flatnonzero(_sliding(padded, grams, False) == h)
    # The windows whose least gram this is lie side by side, as the text's order is.
    first = np.full(len(at), -1)
    last = np.full(len(at), -1)
    # An equal gram within reach to the left takes the windows that hold both; no
    # other anchor can stand between the two.
    taken = np.full(len(at), -1)
    taken[1:] = np.where(h[at[1:]] == h[at[:-1]], at[:-1], -1)
    for back in range(grams - 1, -1, -1):
        w = at - back
        inside = (w > taken) & (w >= 0) & (w < len(least))
        mine = inside & (least[np.clip(w, 0, len(least) - 1)] == h[at])
        first = np.where(mine & (first < 0), w, first)
        last = np.where(mine, w, last)
    has = first >= 0
    return at[has], h[at[has]], first[has], last[has]


def deep_windows(words: Words) -> np.ndarray:
    """Which windows occur more than once: the leaves under nodes of depth 35.

    Top-down over edges of several words; leaves alone in a node end there.
    """
    at = words.windows(WINDOW)
    for depth in (12, 23):
        _, node, size = np.unique(words.hash(at, depth), return_inverse=True, return_counts=True)
        at = at[size[node] > 1]
    low, high = words.hash(at, WINDOW), words.hash(at, WINDOW, 1)
    order = np.lexsort((high, low))
    same = (low[order][1:] == low[order][:-1]) & (high[order][1:] == high[order][:-1])
    shared = np.zeros(len(at), dtype=bool)
    shared[order[1:]] |= same
    shared[order[:-1]] |= same
    return at[shared]


def _joined(at: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of consecutive windows of one text: positions of first and last in ``at``."""
    if not len(at):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    new = np.flatnonzero((np.diff(at) != 1) | (np.diff(of) != 0)) + 1
    return np.concatenate([[0], new]), np.concatenate([new, [len(at)]]) - 1


def _bit(h: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    place = h >> np.uint64(1) & np.uint64(bits - 1)  # the lowest bit of an anchor is set
    return (place >> np.uint64(6)).astype(np.int64), place & np.uint64(63)


def _hit(table: np.ndarray, h: np.ndarray) -> np.ndarray:
    word, bit = _bit(h, 64 * len(table))
    return (table[word] >> bit & np.uint64(1)).astype(bool)


def _tables(counted: DataFrame, bits: int, group_size: int) -> tuple[np.ndarray, np.ndarray]:
    """Bit tables of repeated and of frequent anchors."""
    place = F.shiftrightunsigned("anchor", 1).bitwiseAND(F.lit(bits - 1))
    flag = F.expr("shiftleft(1L, cast(shiftrightunsigned(anchor, 1) & 63 as int))")
    rows = counted.groupBy(F.shiftright(place, 6).alias("word")).agg(
        F.bit_or(flag).alias("repeated"),
        F.bit_or(F.when(F.col("n") > group_size, flag).otherwise(F.lit(0).cast("bigint"))).alias("frequent"),
    ).toArrow()  # at most bits / 64 rows
    out = []
    for name in ("repeated", "frequent"):
        table = np.zeros(bits // 64, dtype=np.uint64)
        table[rows["word"].to_numpy()] = rows[name].to_numpy().view(np.uint64)
        out.append(table)
    return out[0], out[1]


def _keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(
        F.col(doc_id).cast("string").alias("_id"), F.xxhash64(F.col(text)).alias("_hash"),
        F.col(text).alias("_text"),
    )


def repeats(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", group_size: int = GROUP_SIZE,
    filter_bits: int | None = None,
) -> DataFrame:
    """Repeated ranges: ``_id`` (as text), ``_hash`` of the text, word range ``lo`` to ``hi``.

    A range is as long as every window of 35 words in it occurs elsewhere too.  Ranges of
    a text may overlap by less than a window; together they cover exactly the words of
    repeated windows.  ``group_size`` and ``filter_bits`` change no range.
    """
    return _spans(docs, doc_id, text, group_size, filter_bits).select(
        "_id", "_hash", F.inline("_spans").alias("lo", "hi")
    )


def _spans(
    docs: DataFrame, doc_id: str, text: str, group_size: int, filter_bits: int | None
) -> DataFrame:
    """``_id``, ``_hash`` and, in order, all ranges of each text that has one."""
    spark = docs.sparkSession
    rows = _keyed(docs, doc_id, text).filter(F.col("_text").isNotNull())

    def count(batches: Iterator[pa.RecordBatch]):
        for _, texts in text_chunks(batches, "_text", _CHUNK):
            _, h, _, _ = anchors(Words(texts))
            h, n = np.unique(h, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n)], ["anchor", "n"])

    counted = rows.select("_text").mapInArrow(released(count), "anchor bigint, n bigint").groupBy("anchor").agg(
        F.sum("n").alias("n")
    ).filter("n > 1")
    counted = materialise(counted)
    if filter_bits is None:
        filter_bits = min(MOST_BITS, max(LEAST_BITS, 1 << (16 * counted.count()).bit_length()))
    shared = spark.sparkContext.broadcast(_tables(counted, filter_bits, group_size))

    def cut(batches: Iterator[pa.RecordBatch], frequent: bool):
        repeated, often = shared.value
        for batch, texts in text_chunks(batches, "_text", _CHUNK):
            words = Words(texts, (1, 2) if frequent else (1,))
            at, h, first, last = anchors(words)
            kept = _hit(repeated, h) & (_hit(often, h) == frequent)
            h, first, last = h[kept], first[kept], last[kept]
            of = words.text[first] if len(first) else first
            lo = first - words.first[of]
            if frequent:
                size = last - first + 1
                row = np.repeat(np.arange(len(h)), size)
                w = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size) + first[row]
                columns = [
                    pa.array(words.hash(w, WINDOW).view(np.int64)),
                    pa.array(words.hash(w, WINDOW, 1).view(np.int64)),
                    pa.array((w - words.first[of[row]]).astype(np.int32)),
                ]
                of, names = of[row], ["low", "high", "lo"]
            else:
                begin, end = words.start[first], words.end[last + WINDOW - 1] if len(last) else last
                runs = [words.raw[a:b] for a, b in zip(begin.tolist(), end.tolist(), strict=True)]
                columns = [pa.array(h.view(np.int64)), pa.array(runs, pa.binary()), pa.array(lo.astype(np.int32))]
                names = ["anchor", "run", "lo"]
            take = pa.array(of.astype(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(take), batch.column(1).take(take), *columns], ["_id", "_hash", *names]
            )

    def trees(batches: Iterator[pa.RecordBatch]):
        """Groups come whole and in order; many small ones are handled together."""
        held: list[pa.RecordBatch] = []

        def built(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
            part = pa.Table.from_batches(parts).combine_chunks()
            words = Words(part.column("run").to_pylist(), (1, 2))
            at = deep_windows(words)
            of = words.text[at] if len(at) else at
            a, b = _joined(at, of)
            lo = part.column("lo").to_numpy()[of[a]] + at[a] - words.first[of[a]] if len(a) else a
            take = pa.array(of[a])
            out = part.take(take).combine_chunks()
            return pa.RecordBatch.from_arrays(
                [out.column("_id").combine_chunks(), out.column("_hash").combine_chunks(),
                 pa.array(lo.astype(np.int32)), pa.array((lo + at[b] - at[a] + WINDOW).astype(np.int32))],
                ["_id", "_hash", "lo", "hi"],
            )

        size = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            h = batch.column(2).to_numpy()
            while batch.num_rows:
                if size > _CHUNK:  # hand over what is held, at the next change of group
                    last = held[-1].column(2)[-1].as_py()
                    end = int(np.searchsorted(h != last, True)) if (h != last).any() else len(h)
                    end = 0 if len(h) and h[0] != last else end
                    if end:
                        held.append(batch.slice(0, end))
                        batch, h = batch.slice(end), h[end:]
                    if len(h):
                        yield built(held)
                        held, size = [], 0
                    continue
                step = min(batch.num_rows, 4096)
                held.append(batch.slice(0, step))
                size += held[-1].column(3).nbytes
                batch, h = batch.slice(step), h[step:]
        if held:
            yield built(held)

    runs = rows.mapInArrow(released(lambda b: cut(b, False)), "_id string, _hash bigint, anchor bigint, run binary, lo int")
    found = runs.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(released(trees), "_id string, _hash bigint, lo int, hi int"
    )
    if shared.value[1].any():
        long = rows.mapInArrow(released(lambda b: cut(b, True)), "_id string, _hash bigint, low bigint, high bigint, lo int")
        sizes = long.groupBy("low", "high").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        # By the row: copies of a text, and of an id read by several tasks, are dealt out too.
        salt = F.xxhash64("_id", "lo", F.spark_partition_id())
        known = salted_lookup(long, sizes, ["low", "high"], salt, 32).filter(F.col("n").isNotNull())
        found = found.union(known.select("_id", "_hash", "lo", (F.col("lo") + WINDOW).alias("hi")))
    each = found.groupBy("_id", "_hash").agg(
        F.sort_array(F.collect_set(F.struct("lo", "hi"))).alias("spans")  # a text's own
    )
    return each.select("_id", "_hash", _merged("spans").alias("_spans"))


def _merged(spans: str) -> Column:
    """Sorted ranges of one text, joined where the windows in them are neighbours: where
    a range starts at most one word after the last window of the one before it.  Each
    window is in one range, so those that start later also end later."""
    all_ = F.col(spans)

    def parted(left: Column, right: Column) -> Column:
        return F.coalesce(right["lo"] > left["hi"] - WINDOW + 1, F.lit(True))

    first = F.filter(all_, lambda x, i: (i == 0) | parted(F.get(all_, i - 1), x))
    last = F.filter(all_, lambda x, i: parted(x, F.get(all_, i + 1)))
    return F.arrays_zip(
        F.transform(first, lambda x: x["lo"]).alias("lo"), F.transform(last, lambda x: x["hi"]).alias("hi")
    )


def remove_repeats(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", group_size: int = GROUP_SIZE,
    filter_bits: int | None = None,
) -> DataFrame:
    """``docs`` with repeats taken out of the text, and ``n_words``, ``n_removed``.

    Each word covered by a window of 35 words that also starts elsewhere, in this or
    another text, goes, wherever it stands; windows are judged on the input.  The words
    left are joined by one blank where anything was removed, and an untouched text
    stays as it is.  Null stays null, with no words.  Repeated rows are copies of each
    other.  Columns named ``n_words`` or ``n_removed``, in any case, are replaced.
    """
    found = materialise(_spans(docs, doc_id, text, group_size, filter_bits))
    names = ["n_words", "n_removed"]
    kept = carried(docs, names)
    others = [c for c in kept if c != text]
    keyed = beside(
        docs, others, text=F.col(text), d=F.col(doc_id).cast("string"), h=F.xxhash64(F.col(text))
    )
    same = F.col("d").eqNullSafe(F.col("_id")) & (F.col("h") == F.col("_hash"))
    joined = keyed.join(found, same, "left").select(
        "row", "text", F.col("_spans.lo").alias("lo"), F.col("_spans.hi").alias("hi")
    )

    def work(batches):
        for batch, texts in text_chunks(batches, "text"):
            before = batch.column(1)
            los, his = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            out, n_words, n_removed = [], [], []
            for i, t in enumerate(texts):
                words = t.split()
                n_words.append(len(words))
                if not los[i]:
                    out.append(before[i].as_py())
                    n_removed.append(0)
                    continue
                left, at = [], 0
                for lo, hi in zip(los[i], his[i], strict=True):
                    if lo > at:
                        left += words[at:lo]
                    at = max(at, hi)
                left += words[at:]
                out.append(b" ".join(left).decode())
                n_removed.append(len(words) - len(left))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(out, pa.string()), pa.array(n_words, pa.int64()),
                 pa.array(n_removed, pa.int64())], ["row", "text", *names]
            )

    schema = row_schema(joined, "text string, n_words bigint, n_removed bigint")
    made = joined.mapInArrow(released(work), schema)
    return made.select(
        *(F.col("text").alias(c) if c == text else F.col("row")[c].alias(c) for c in kept), *names
    )
