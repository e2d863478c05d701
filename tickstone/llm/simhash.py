"""Near-duplicate documents by SimHash fingerprints compared bit-sliced.

Fingerprints within two bits agree on at least two of their four 16-bit quarters,
so comparing the members of each (two quarters, value) bucket finds every link.
A bucket of more than ``split_above`` fingerprints is split once more by the same
argument on the 32 bits left: two of their four bytes agree.  Members of such a
bucket share 48 bits, so no bucket ever holds more than 65,536 different ones.

Within a bucket the bits are stored vertically: one plane per bit position, one
lane per fingerprint.  A fingerprint meets 64 lanes per machine word; the planes of
differing bits go through a carry-save counter (ones, twos, more), and a block of
lanes is left as soon as every lane in it is beyond the radius.  Only a spanning
forest of a bucket's links leaves the task: components are the same, and a group of
n copies gives n links and not n squared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scratch import materialise
from .common import beside, released, text_chunks, unpacked
from .components import components

SHINGLE = 3
RADIUS = 2
#: Different fingerprints in one bucket above which it is split.
SPLIT_ABOVE = 2048
_SEED = 42  # fixed value: seed of the shingle hash
_LANES = 4096  # lanes of a block: 64 machine words
_QUERIES = 256  # fingerprints that meet a block together


def fingerprints(texts: list[bytes], shingle: int = SHINGLE) -> np.ndarray:
    """The 64-bit fingerprint of each UTF-8 text; zero without a word."""
    hashes, starts, sizes = [], [], []
    for t in texts:
        words = t.lower().split()  # bytes: ASCII letters and ASCII white space alone
        starts.append(len(hashes))
        if words:
            line = b" ".join(words)
            n = max(1, len(words) - shingle + 1)
            ends = np.cumsum([len(w) + 1 for w in words])
            first = [0, *(ends[: n - 1].tolist())]
            last = (ends[-n:] - 1).tolist()
            hashes += [xxhash.xxh64_intdigest(line[a:b], _SEED) for a, b in zip(first, last, strict=True)]
        sizes.append(len(hashes) - starts[-1])
    out = np.zeros(len(texts), dtype=np.uint64)
    size = np.array(sizes)
    full = np.flatnonzero(size)
    if not len(full):
        return out
    h = np.array(hashes, dtype=np.uint64)
    weights = np.uint64(1) << np.arange(64, dtype=np.uint64)
    for k in full:  # one text at a time keeps the bit table small
        part = h[starts[k] : starts[k] + size[k]]
        set_in = np.zeros(64, dtype=np.int64)
        for at in range(0, len(part), 1 << 16):
            bits = np.unpackbits(
                part[at : at + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8),
                axis=1, bitorder="little",
            )
            set_in += bits.sum(axis=0, dtype=np.int64)
        out[k] = weights[2 * set_in > size[k]].sum(dtype=np.uint64)
    return out


def _planes(f: np.ndarray) -> np.ndarray:
    """Bit planes: row i holds bit i of 64 fingerprints per word."""
    lanes = -(-len(f) // 64) * 64
    padded = np.zeros(lanes, dtype="<u8")
    padded[: len(f)] = f
    bits = np.unpackbits(padded.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.packbits(bits.T, axis=1, bitorder="little").copy().view("<u8")


def within(planes: np.ndarray, ones_of: np.ndarray, radius: int) -> np.ndarray:
    """A row per query fingerprint: which lanes behind ``planes`` differ from it in
    at most ``radius`` bits (0 to 2).

    ``ones`` and ``twos`` count each lane's differing bits; ``over`` marks lanes
    past the radius for good, and a block whose lanes are all over is abandoned.
    """
    shape = len(ones_of), planes.shape[1]
    ones, twos, over = (np.zeros(shape, dtype=np.uint64) for _ in range(3))
    everything = np.uint64(0xFFFFFFFFFFFFFFFF)
    for bit in range(64):
        flip = np.where(ones_of >> np.uint64(bit) & np.uint64(1), everything, np.uint64(0))
        differs = planes[bit] ^ flip[:, None]
        carry = ones & differs
        ones ^= differs
        over |= twos & carry  # a fourth bit
        twos |= carry
        over |= (ones & twos) if radius == 2 else twos if radius == 1 else ones | twos
        if bit % 8 == 7 and (over == everything).all():
            break
    return ~np.unpackbits(over.view(np.uint8), axis=1, bitorder="little").astype(bool)


def bucket_links(f: np.ndarray, radius: int = RADIUS) -> list[tuple[int, int]]:
    """A spanning forest of the links between different fingerprints of a bucket."""
    if len(f) == 2:  # most buckets
        return [(0, 1)] if int(f[0] ^ f[1]).bit_count() <= radius else []
    root = list(range(len(f)))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    links = []
    for start in range(0, len(f), _LANES):
        block = f[start : start + _LANES]
        planes = _planes(block)
        for low in range(0, start + len(block), _QUERIES):
            asked = f[low : min(low + _QUERIES, start + len(block))]
            which, lane = np.nonzero(within(planes, asked, radius)[:, : len(block)])
            for i, j in zip((which + low).tolist(), (lane + start).tolist(), strict=True):
                if i < j and (a := find(i)) != (b := find(j)):
                    root[max(a, b)] = min(a, b)
                    links.append((i, j))
    return links


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links within runs of equal (part, bits), which come sorted."""
    held: list[np.ndarray] = []  # parts of the bucket not yet ended
    last = None

    def links_of(bucket: list[np.ndarray], into: list) -> None:
        f = np.concatenate(bucket)
        if len(f) > 1:
            into += [(f[i], f[j]) for i, j in bucket_links(f.view(np.uint64))]

    for batch in batches:
        found: list = []
        part, bits, f = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(3))
        if len(part):
            cut = np.flatnonzero((part[1:] != part[:-1]) | (bits[1:] != bits[:-1])) + 1
            runs = np.split(f, cut)
            first = (part[0], bits[0])
            if held and first != last:
                links_of(held, found)
                held = []
            held.append(runs[0])
            for run in runs[1:]:
                if len(held) > 1 or len(held[0]) > 1:
                    links_of(held, found)
                held = [run]
            last = (part[-1], bits[-1])
        yield _pairs(found)
    if held:
        found = []
        links_of(held, found)
        yield _pairs(found)


def _pairs(found: list) -> pa.RecordBatch:
    ends = np.array(found, dtype=np.int64).reshape(-1, 2)
    return pa.RecordBatch.from_arrays([pa.array(ends[:, 0]), pa.array(ends[:, 1])], ["a", "b"])


def _bits(value, start: int, size: int):
    return F.shiftrightunsigned(value, start).bitwiseAND(F.lit((1 << size) - 1))


def _two_of_four(pieces: list) -> list:
    """(pair number, the pair's bits as one number) for each two of four pieces."""
    pairs = [(i, j) for i in range(4) for j in range(i + 1, 4)]
    return [(k, pieces[i], pieces[j]) for k, (i, j) in enumerate(pairs)]


def fingerprint_links(prints: DataFrame, split_above: int = SPLIT_ABOVE) -> DataFrame:
    """Links ``a``, ``b`` that connect what lies within two bits, from the different
    fingerprints in column ``f``."""
    f = F.col("f")
    quarters = [_bits(f, 16 * k, 16) for k in range(4)]
    coarse = F.explode(F.array(*[
        F.struct(F.lit(k).alias("part"), (F.shiftleft(x, 16) + y).alias("bits"))
        for k, x, y in _two_of_four(quarters)
    ]))
    rows = prints.select("f", coarse.alias("at")).select("at.part", "at.bits", "f")
    sizes = rows.groupBy("part", "bits").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    rows = rows.join(sizes, ["part", "bits"])
    # The bytes of the two quarters a coarse bucket does not fix.
    free = [(2, 3), (1, 3), (1, 2), (0, 3), (0, 2), (0, 1)]
    left = F.lit(None)
    for k, (x, y) in enumerate(free):
        spare = [_bits(f, 16 * q + 8 * h, 8) for q in (x, y) for h in (0, 1)]
        finer = F.array(*[
            F.struct(
                (F.lit(6 + 6 * k + m)).alias("part"),
                (F.shiftleft(F.col("bits"), 16) + F.shiftleft(u, 8) + v).alias("bits"),
            )
            for m, u, v in _two_of_four(spare)
        ])
        left = F.when(F.col("part") == k, finer).otherwise(left)
    same = F.array(F.struct("part", "bits"))
    keyed = rows.select(
        "f", F.explode(F.when(F.col("n") > split_above, left).otherwise(same)).alias("at")
    ).select("at.part", "at.bits", "f")
    sorted_rows = keyed.repartition("part", "bits").sortWithinPartitions("part", "bits", "f")
    return sorted_rows.mapInArrow(released(_compare), "a bigint, b bigint").distinct()


def with_fingerprints(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE
) -> DataFrame:
    """``doc_id``, ``text_hash`` (null for a null text) and the fingerprint ``f`` (signed
    64 bits), one row per row."""

    def work(batches):
        for batch, texts in text_chunks(batches, "_text"):
            f = fingerprints(texts, shingle)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(f.view(np.int64))],
                ["doc_id", "text_hash", "f"],
            )

    rows = docs.select(
        F.col(doc_id).alias("doc_id"), _text_hash(text).alias("text_hash"), F.col(text).alias("_text")
    )
    return rows.mapInArrow(
        released(work), f"doc_id {dict(rows.dtypes)['doc_id']}, text_hash bigint, f bigint"
    )


def _text_hash(text: str) -> Column:
    return F.when(F.col(text).isNotNull(), F.xxhash64(text))


def _rooted(prints: DataFrame, split_above: int) -> DataFrame:
    """``prints`` (column ``f`` of different fingerprints, and ``least``) with the
    fingerprint ``root`` that names the component."""
    roots = components(fingerprint_links(prints.select("f"), split_above))
    return prints.join(roots, prints["f"] == roots["node"], "left").select(
        "f", "least", F.coalesce("root", "f").alias("root")
    )


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
    split_above: int = SPLIT_ABOVE,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``f``, ``component_id``.

    Two documents link when their fingerprints differ in at most two bits;
    ``component_id`` is the smallest id reachable over links, itself included.
    Null, empty and wordless texts have fingerprint zero and link like any other.
    Rows that share an id each keep their own fingerprint.  A null id is never the
    smallest; a component of null ids alone has a null id.
    """
    rows = materialise(with_fingerprints(docs, doc_id, text, shingle).select("doc_id", "f"))
    named = _rooted(rows.groupBy("f").agg(F.min("doc_id").alias("least")), split_above)
    smallest = named.groupBy("root").agg(F.min("least").alias("component_id"))
    by_print = materialise(named.join(smallest, "root").select(F.col("f").alias("_f"), "component_id"))
    # One fingerprint may hold a third of all rows: its fact is repeated per salt.
    salts = 16
    spread = by_print.withColumn("_s", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64("doc_id"), F.lit(salts)).cast("int"))
    return salted.join(
        spread, (F.col("f") == F.col("_f")) & (F.col("_salt") == F.col("_s")), "left"
    ).select("doc_id", "f", "component_id")


def keep_one(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", split_above: int = SPLIT_ABOVE
) -> DataFrame:
    """``docs`` with one document of each component, that of the smallest id.

    All columns stay, and ids may be of any type that has an order.  Rows without an id come after all that have one.  Of rows under
    the same id (or without any) the first by the hash of its text stays, a null text
    last; of equal texts under it any one.  Rows that share an id but lie in different
    components each stand for their own.
    """
    # By component, and not by id, which other components may hold as well.
    def place(row_id: Column, text_hash: Column) -> Column:  # nulls in a struct equal each other
        return F.struct(
            row_id.isNull().alias("no_id"), row_id.alias("id"),
            text_hash.isNull().alias("no_text"), text_hash.alias("hash"),
        )

    rows = with_fingerprints(docs, doc_id, text)
    prints = materialise(rows.groupBy("f").agg(
        F.min(place(F.col("doc_id"), F.col("text_hash"))).alias("least")
    ))

    def key(row_id: Column, text_hash: Column) -> dict[str, Column]:  # without nulls, of plain types
        return {
            "no_id": row_id.isNull(), "id": F.coalesce(row_id.cast("string"), F.lit("")),
            "no_text": text_hash.isNull(), "hash": F.coalesce(text_hash, F.lit(0)),
        }

    least = _rooted(prints, split_above).groupBy("root").agg(F.min("least").alias("w"))
    winners = least.select(*(c.alias(n) for n, c in key(F.col("w.id"), F.col("w.hash")).items()))
    keyed = beside(docs, docs.columns, **key(F.col(doc_id), _text_hash(text)))
    # Copies are cut to one by each task, so that a hot one does not load the join, which
    # finds the rows where the window has put them.
    by = ["no_id", "id", "no_text", "hash"]
    w = Window.partitionBy(*by).orderBy("hash")
    first = keyed.withColumn("nth", F.row_number().over(w)).filter("nth = 1")
    return unpacked(first.join(winners, by, "left_semi"), docs.columns)
