"""Byte-pair encoding and decoding with a given vocabulary.

Each word keeps a segment tree over the ranks of its adjacent pairs.  The root
holds the lowest rank and, among equals, the leftmost place; a merge changes at
most three leaves, each repaired in a logarithmic number of steps, until the root
says that nothing can be merged.  The trees of many words lie side by side in
numpy arrays, so one step merges one pair of every word that still has one.

White space never lies inside a word, so texts are cut at it and each distinct
piece is encoded once while it stays in a bounded two-generation memory.
"""

from __future__ import annotations

import gc
import hashlib
import json
import re
import unicodedata
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import beside, carried, released, row_schema, text_chunks, unpacked

#: Pieces remembered per generation in one worker.
REMEMBERED = 150_000
#: Words encoded side by side.
SIDE_BY_SIDE = 50_000
_CHUNK = 2 << 20  # text bytes in hand: their distinct pieces must fit the memory above
_NONE = np.int64(1) << 40  # rank of a pair that cannot be merged
# White space of the vocabulary's pattern, its contractions and classes.
_SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
_PLAIN = rb"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\t-\r a-z0-9]+"
_PIECES = rf"'s|'t|'re|'ve|'m|'ll|'d|[\p{{L}}]+|[\p{{N}}]|[^{_SPACE}\p{{L}}\p{{N}}]+"


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in the vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    return [chr(b) if b in shown else chr(256 + rest.index(b)) for b in range(256)]


@dataclass(frozen=True)
class Vocabulary:
    """What encoding needs, as plain arrays: fixed in size by the vocabulary file."""

    tokens: list[str]  # by id
    inner: np.ndarray  # id of a byte inside a word
    last: np.ndarray  # id of a byte that ends a word
    pairs: np.ndarray  # sorted: left id * 2**32 + right id
    ranks: np.ndarray
    merged: np.ndarray  # id the pair becomes
    special: dict[str, int]


def read_vocabulary(path: str) -> Vocabulary:
    """Read a vocabulary file of the word-end kind (lower case, white space dropped)."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    vocab, suffix = spec["model"]["vocab"], spec["model"]["end_of_word_suffix"]
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    tokens = [""] * (max([*vocab.values(), *special.values()]) + 1)
    for token, i in (vocab | special).items():
        tokens[i] = token
    letters = byte_letters()
    rows = [(vocab[a] << 32 | vocab[b], rank, vocab[a + b])
            for rank, (a, b) in enumerate(spec["model"]["merges"])]
    pairs, ranks, merged = np.array(sorted(rows), dtype=np.int64).T.copy()
    return Vocabulary(
        tokens,
        np.array([vocab[c] for c in letters], dtype=np.int64),
        np.array([vocab[c + suffix] for c in letters], dtype=np.int64),
        pairs, ranks, merged, special,
    )


def _rank(v: Vocabulary, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rank of each pair, and the id it becomes; no right side is a negative id."""
    key = left << 32 | np.maximum(right, 0)
    at = np.minimum(np.searchsorted(v.pairs, key), len(v.pairs) - 1)
    known = (v.pairs[at] == key) & (left >= 0) & (right >= 0)
    return np.where(known, v.ranks[at], _NONE), v.merged[at]


def encode_words(v: Vocabulary, words: list[bytes]) -> list[list[int]]:
    """Ids of each non-empty word (letters already normalised, as bytes)."""
    out: list[list[int]] = [[]] * len(words)
    by_width: dict[int, list[int]] = {}
    for i, w in enumerate(words):
        by_width.setdefault(max(2, 1 << (len(w) - 1).bit_length()), []).append(i)
    for width, places in by_width.items():
        step = max(1, SIDE_BY_SIDE * 8 // width)
        for k in range(0, len(places), step):
            part = places[k : k + step]
            for i, ids in zip(part, _encode_block(v, [words[i] for i in part], width), strict=True):
                out[i] = ids
    return out


def _encode_block(v: Vocabulary, words: list[bytes], width: int) -> list[list[int]]:
    """Words of at most ``width`` bytes, a power of two."""
    n, length = len(words), np.array([len(w) for w in words])
    raw = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8)
    raw = raw.reshape(n, width)
    place = np.arange(width)
    ids = v.inner[raw]
    rows = np.arange(n)
    ids[rows, length - 1] = v.last[raw[rows, length - 1]]
    ids[place >= length[:, None]] = -1
    # Links to the neighbours that are still there; width means none.
    after = np.where(place + 1 < length[:, None], place + 1, width)
    before = np.broadcast_to(place - 1, (n, width)).copy()
    # A leaf is rank * width + place: the least leaf is the leftmost lowest rank.
    tree = np.empty((n, 2 * width), dtype=np.int64)
    right = np.concatenate([ids[:, 1:], np.full((n, 1), -1)], axis=1)
    tree[:, width:] = _rank(v, ids, right)[0] * width + place
    for node in range(width - 1, 0, -1):
        np.minimum(tree[:, 2 * node], tree[:, 2 * node + 1], out=tree[:, node])

    def set_leaf(row, at, rank):
        node = at + width
        tree[row, node] = rank * width + at
        while width > 1 and node[0] > 1:  # all nodes are on one level
            node = node >> 1
            tree[row, node] = np.minimum(tree[row, 2 * node], tree[row, 2 * node + 1])

    def id_at(row, at):
        return np.where(at < width, ids[row, np.minimum(at, width - 1)], -1)

    live = rows
    while len(live := live[tree[live, 1] < _NONE * width]):
        at = tree[live, 1] % width
        gone = after[live, at]
        ids[live, at] = _rank(v, ids[live, at], ids[live, gone])[1]
        follower = after[live, gone]
        after[live, at] = follower
        has = follower < width
        before[live[has], follower[has]] = at[has]
        ids[live, gone] = -1
        set_leaf(live, gone, np.full(len(live), _NONE))
        set_leaf(live, at, _rank(v, ids[live, at], id_at(live, follower))[0])
        left = before[live, at]
        row, left, at = live[left >= 0], left[left >= 0], at[left >= 0]
        if len(row):
            set_leaf(row, left, _rank(v, ids[row, left], ids[row, at])[0])
    flat = ids.ravel()
    kept = flat >= 0
    ends = np.cumsum(kept.reshape(n, width).sum(axis=1)).tolist()
    left_over = flat[kept].tolist()
    return [left_over[a:b] for a, b in zip([0, *ends], ends, strict=False)]


def decode(v: Vocabulary, ids: Iterable[int]) -> str:
    """The tokens' texts joined by one blank: this vocabulary names no other decoder,
    and special tokens are kept.  Texts can thus be decoded piece by piece."""
    return " ".join([v.tokens[i] for i in ids])


class Encoder:
    """Encodes texts of UTF-8 bytes; remembers the pieces between white space."""

    def __init__(self, v: Vocabulary):
        self.v = v
        self.names = [str(i) for i in range(len(v.tokens))]
        self.pieces = regex.compile(_PIECES)
        self.plain = re.compile(_PLAIN)
        self.special = regex.compile("|".join(map(regex.escape, v.special)).encode() or rb"(?!)")
        self.new: dict[bytes, tuple[str, str]] = {}
        self.old: dict[bytes, tuple[str, str]] = {}

    def words(self, piece: bytes) -> list[bytes]:
        """A piece normalised and cut into words."""
        if piece.isascii():  # the same classes, without decoding
            piece = piece.lower()
            return [piece] if piece.isalpha() else self.plain.findall(piece)
        text = unicodedata.normalize("NFC", piece.decode("utf-8"))
        # Each letter is lowered by itself, so a sigma never takes its final form.
        return [w.encode() for w in self.pieces.findall(text.replace("Σ", "σ").lower())]

    def learn(self, pieces: set[bytes]) -> dict[bytes, tuple[str, str]]:
        """Ids, as text, and decoded text of each distinct piece."""
        known, missing, new, old = {}, [], self.new, self.old
        for p in pieces:
            hit = new.get(p) or old.get(p)
            if hit is None:
                missing.append(p)
            else:
                known[p] = hit
        cut = [self.words(p) for p in missing]
        distinct = list({w for ws in cut for w in ws})
        names = self.names
        texts = {
            w: (" ".join([names[i] for i in ids]), decode(self.v, ids))
            for w, ids in zip(distinct, encode_words(self.v, distinct), strict=True)
        }
        for p, ws in zip(missing, cut, strict=True):
            if len(ws) == 1:
                known[p] = texts[ws[0]]
            else:
                known[p] = tuple(" ".join([texts[w][k] for w in ws]) for k in (0, 1))
        if len(new) + len(known) > REMEMBERED:
            self.old, self.new = new, {}
        if len(known) <= REMEMBERED:
            self.new.update(known)
        return known

    def encode(self, texts: list[bytes]) -> Iterator[tuple[str, str]]:
        """Ids and decoded tokens of each text, both joined by blanks."""
        cut = []
        for t in texts:
            if self.v.special and b"<|" in t and self.special.search(t):
                # Special tokens stand in the raw text and part the words around them.
                pieces, at = [], 0
                for m in self.special.finditer(t):
                    pieces += [*t[at : m.start()].split(), m.group()]
                    at = m.end()
                cut.append(pieces + t[at:].split())
            else:
                cut.append(t.split())
        known = self.learn({p for ps in cut for p in ps} - self.named.keys()) | self.named
        ids = {p: x for p, (x, _) in known.items()}
        shown = {p: x for p, (_, x) in known.items()}
        hollow = any(not x for x in ids.values())  # a piece of exotic white space alone
        for ps in cut:
            if hollow:
                ps = [p for p in ps if ids[p]]
            yield " ".join(map(ids.__getitem__, ps)), " ".join(map(shown.__getitem__, ps))

    @property
    def named(self) -> dict[bytes, tuple[str, str]]:
        return {k.encode(): (str(i), k) for k, i in self.v.special.items()}


def _per_text(docs, text: str, vocabulary: Vocabulary, keep, fields: list, make) -> DataFrame:
    """The kept columns, and those made from each text's ids and decoded tokens."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    names = [f.name for f in fields]
    kept = carried(docs, names, keep)
    rows = beside(docs, kept, text=F.col(text))
    schema = row_schema(rows, ", ".join(f"{f.name} {f.type_name}" for f in fields))

    def work(batches):
        encoder = Encoder(shared.value)
        gc.disable()  # a million small strings and no cycles: walking them is waste
        try:
            for batch, texts in text_chunks(batches, "text", _CHUNK):
                made = list(zip(*(make(i, d) for i, d in encoder.encode(texts)), strict=True))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), *(pa.array(m, f.arrow) for m, f in zip(made, fields, strict=True))],
                    ["row", *names],
                )
        finally:
            gc.enable()

    return unpacked(rows.mapInArrow(released(work), schema), kept, *names)


@dataclass(frozen=True)
class _Field:
    name: str
    type_name: str
    arrow: pa.DataType


def encode_texts(
    docs: DataFrame, vocabulary: Vocabulary, text: str = "text", keep: Sequence[str] | None = None
) -> DataFrame:
    """``docs`` with ``token_ids`` (array of int) and ``decoded`` (text).

    A null or empty text has no tokens and decodes to empty text.  Columns of
    these two names are replaced, all others (or those in ``keep``) stay; every row
    gives one row.
    """
    fields = [
        _Field("token_ids", "array<int>", pa.list_(pa.int32())),
        _Field("decoded", "string", pa.string()),
    ]
    return _per_text(
        docs, text, vocabulary, keep, fields, lambda i, d: (np.fromstring(i, np.int32, sep=" "), d)
    )


def encode_digests(
    docs: DataFrame, vocabulary: Vocabulary, text: str = "text", keep: Sequence[str] | None = None
) -> DataFrame:
    """``docs`` with the number of tokens and the SHA-256 of ids and decoded text.

    The same encoding as :func:`encode_texts`, with the sequences digested where
    they are made.  A null text counts as empty: no tokens, digests of empty text.
    """

    def sha(x: str) -> str:
        return hashlib.sha256(x.encode()).hexdigest()

    fields = [
        _Field("n_tokens", "bigint", pa.int64()),
        _Field("ids_sha256", "string", pa.string()),
        _Field("decoded_sha256", "string", pa.string()),
    ]
    return _per_text(
        docs, text, vocabulary, keep, fields,
        lambda i, d: (i.count(" ") + 1 if i else 0, sha(i), sha(d)),
    )
