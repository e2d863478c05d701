"""Exact top-k search by inner product: tiled matrix products of queries and shards.

Vectors are quantised to whole numbers once and dealt to shards of bounded size; every
query block visits every shard.  A task loads its shard, sorted by id, and lets the
queries stream past it in blocks: each tile (a query block times a slice of the shard) is
one matrix product, out of which only each query's best k are taken, ties to the smaller
id.  The lists of a query are then merged by a tree of groups, ``FAN`` at a time, so that
no task ever holds more than ``FAN * k`` entries of a query.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scratch import materialise
from .common import released

K = 5
#: Vectors in a shard when there are enough shards, and at the most on average.
SHARD_ROWS, MOST_ROWS = 1 << 11, 1 << 17
#: Sides of a tile.
TILE_QUERIES, TILE_ROWS = 256, 1 << 13
#: Lists that one merge takes in.
FAN = 16
#: Whole numbers are exact in the products of doubles below this.
_EXACT = float(1 << 53)
_LARGEST = (1 << 63) - 1

_CODES = "vec_id bigint, asked boolean, dim int, code binary"
_CODES_ARROW = pa.schema([
    ("vec_id", pa.int64()), ("asked", pa.bool_()), ("dim", pa.int32()), ("code", pa.binary())
])
_LISTS = "query_id bigint, query binary, shard int, best array<struct<score: bigint, vec_id: bigint>>"
_BEST = pa.list_(pa.struct([("score", pa.int64()), ("vec_id", pa.int64())]))
_LISTS_ARROW = pa.schema([
    ("query_id", pa.int64()), ("query", pa.binary()), ("shard", pa.int32()), ("best", _BEST)
])


# --- quantising --------------------------------------------------------------


def _quantised(scale: float):
    """Vectors as ``floor(scale * x)``: two bytes a component where they fit, else eight."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("vector")
            usable = lists.is_valid().to_numpy(zero_copy_only=False)
            ends = np.asarray(lists.offsets)
            sizes = np.diff(ends)
            flat = lists.values.cast(pa.float64()).to_numpy(zero_copy_only=False)  # null as nan
            bad = np.concatenate([[0], np.cumsum(~np.isfinite(flat))])
            usable &= bad[ends[1:]] == bad[ends[:-1]]
            with np.errstate(over="ignore"):
                codes = np.floor(flat * scale)
            out = []
            for i in np.flatnonzero(usable):
                code = codes[ends[i]:ends[i + 1]]
                small = not len(code) or np.abs(code).max() < 1 << 15
                out.append(code.astype("<i2" if small else "<f8").tobytes())
            keep = pa.array(usable)
            yield pa.record_batch([
                batch.column("vec_id").filter(keep), batch.column("asked").filter(keep),
                pa.array(sizes[usable], pa.int32()), pa.array(out, pa.binary()),
            ], schema=_CODES_ARROW)

    return run


def quantise(
    vectors: DataFrame, asked: Column, vec_id: str = "vec_id", vector: str = "embedding",
    scale: float = 256.0,
) -> DataFrame:
    """``vec_id, asked, dim, code`` of every vector that is not null and holds neither
    null nor non-finite components; ``asked`` tells the queries."""
    rows = vectors.select(
        F.col(vec_id).cast("bigint").alias("vec_id"),
        F.coalesce(asked & F.col(vec_id).isNotNull(), F.lit(False)).alias("asked"),
        F.col(vector).cast("array<double>").alias("vector"),
    )
    return rows.mapInArrow(released(_quantised(scale)), _CODES)


# --- one shard ---------------------------------------------------------------


def _matrix(codes: list[bytes], dim: int) -> np.ndarray:
    """Codes as the rows of a matrix of doubles."""
    out = np.empty((len(codes), dim))
    for i, code in enumerate(codes):
        out[i] = np.frombuffer(code, "<i2" if len(code) == 2 * dim else "<f8")
    return out


def products(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """All inner products, exact: by doubles where no partial sum can leave their exact
    range, else by whole numbers of any size, held within 64 bits."""
    most = np.abs(queries).max(initial=0) * np.abs(rows).max(initial=0) * max(queries.shape[1], 1)
    if most < _EXACT:
        return queries @ rows.T
    plain = [[[int(x) if np.isfinite(x) else int(np.sign(x)) * _LARGEST for x in r] for r in m]
             for m in (queries, rows)]
    out = np.empty((len(queries), len(rows)), dtype=object)
    for i, q in enumerate(plain[0]):
        for j, r in enumerate(plain[1]):
            score = sum(a * b for a, b in zip(q, r, strict=True))
            out[i, j] = max(-_LARGEST, min(_LARGEST, score))
    return out


def select(scores: np.ndarray, k: int) -> list[np.ndarray]:
    """For each row the places of its ``k`` largest scores, best first, ties to the left;
    minus infinity is no score."""
    width = scores.shape[1]
    if width > k and scores.dtype != object:
        least = np.partition(scores, width - k, axis=1)[:, width - k, None]
        above, level = scores > least, scores == least
        room = k - above.sum(axis=1, keepdims=True)
        taken = above | (level & (np.cumsum(level, axis=1) <= room))
    else:
        taken = np.ones(scores.shape, bool)
    out = []
    for row, mask in zip(scores, taken, strict=True):
        at = np.flatnonzero(mask & (row > -np.inf))
        order = sorted(range(len(at)), key=lambda j: (-row[at[j]], j))[:k]
        out.append(at[order])
    return out


class _Shard:
    """The vectors of one shard, in the order of their ids, null ids last."""

    def __init__(self, ids: list[int | None], codes: list[bytes], dim: int):
        order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0))
        self.ids = [ids[i] for i in order]
        self.named = np.array([i for i in self.ids if i is not None], dtype=np.int64)
        self.codes = [codes[i] for i in order]
        self.dim = dim

    def best(self, query_ids: list[int], queries: np.ndarray, k: int) -> list[list[dict]]:
        """Each query's best ``k`` of the shard, its own rows left out."""
        own = np.stack([
            np.searchsorted(self.named, query_ids, "left"),
            np.searchsorted(self.named, query_ids, "right"),
        ])
        lists: list[list[tuple]] = [[] for _ in query_ids]
        for lo in range(0, len(self.codes), TILE_ROWS):
            rows = _matrix(self.codes[lo:lo + TILE_ROWS], self.dim)
            scores = products(queries, rows)
            starts, ends = np.clip(own - lo, 0, len(rows))
            for i in np.flatnonzero(starts < ends):
                scores[i, starts[i]:ends[i]] = -np.inf
            for i, at in enumerate(select(scores, k)):
                lists[i] += [(int(scores[i, j]), lo + int(j)) for j in at]
        return [
            [{"score": s, "vec_id": self.ids[j]} for s, j in sorted(found, key=lambda x: (-x[0], x[1]))[:k]]
            for found in lists
        ]


def _searched(k: int):
    """Rows sorted by (dim, shard, kind): a shard's vectors, then all queries of its size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, ids, codes, shard = None, [], [], None
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("dim", "shard", "asks", "vec_id", "code"))
            waiting: list[tuple[int, bytes]] = []
            for dim, number, asks, vec_id, code in zip(*columns, strict=True):
                if (dim, number) != now:
                    yield from answered(shard, waiting, now)
                    now, ids, codes, shard, waiting = (dim, number), [], [], None, []
                if not asks:
                    ids.append(vec_id)
                    codes.append(code)
                    continue
                if shard is None:
                    shard = _Shard(ids, codes, dim)
                    ids, codes = [], []
                waiting.append((vec_id, code))
                if len(waiting) == TILE_QUERIES:
                    yield from answered(shard, waiting, now)
                    waiting = []
            yield from answered(shard, waiting, now)

    def answered(shard, waiting, now):
        if not waiting or not shard.codes:
            return
        names = [i for i, _ in waiting]
        best = shard.best(names, _matrix([c for _, c in waiting], shard.dim), k)
        yield pa.record_batch([
            pa.array(names, pa.int64()), pa.array([c for _, c in waiting], pa.binary()),
            pa.array([now[1]] * len(names), pa.int32()), pa.array(best, _BEST),
        ], schema=_LISTS_ARROW)

    return run


# --- all shards --------------------------------------------------------------


def merge_lists(lists: DataFrame, shards: int, k: int) -> DataFrame:
    """One list for each query out of those of its shards, ``FAN`` at a time."""
    empty = F.array().cast("array<struct<down: bigint, unnamed: boolean, vec_id: bigint>>")
    now = lists.select(
        "query_id", "query", "shard",
        F.transform("best", lambda b: F.struct(
            (-b["score"]).alias("down"), b["vec_id"].isNull().alias("unnamed"), b["vec_id"].alias("vec_id")
        )).alias("best"),
    )
    while True:
        now = now.withColumn("shard", F.floor(F.col("shard") / FAN).cast("int"))
        shards = -(-shards // FAN)
        now = now.groupBy("query_id", "query", "shard").agg(
            F.slice(F.sort_array(F.coalesce(F.flatten(F.collect_list("best")), empty)), 1, k).alias("best")
        )
        if shards <= 1:
            return now


def top_k(
    vectors: DataFrame, asked: Column, k: int = K, vec_id: str = "vec_id",
    vector: str = "embedding", scale: float = 256.0, shards: int | None = None,
) -> DataFrame:
    """The ``k`` best vectors for each query: ``query_id, rank, vec_id, score``.

    Queries are the rows ``asked`` is true for; the score is the inner product of the
    vectors with each component ``x`` as ``floor(scale * x)``, and ties go to the smaller
    id.  A query meets all vectors of its number of components but those under its own
    id; with fewer than ``k`` of these it gets them all, with none no row.

    Ids are whole numbers.  Null vectors and vectors that hold a null or non-finite
    component take no part; an empty vector scores 0 with other empty ones.  A null id
    asks nothing and ranks after all ids it ties with.  A row held several times is
    found several times, but asks once; an id with several vectors asks with each.
    Scores beyond 64 bits stand at the largest.  No rows give no rows.
    """
    spark = vectors.sparkSession
    stored = materialise(quantise(vectors, asked, vec_id, vector, scale))
    if shards is None:
        n = stored.count()
        wide = int(spark.conf.get("spark.sql.shuffle.partitions"))
        shards = max(-(-n // MOST_ROWS), min(-(-n // SHARD_ROWS), wide), 1)
    # Stored rows keep their order, so a repeated task deals them out alike, and copies
    # of one row are dealt out too.
    at = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(shards)).cast("int")
    rows = stored.select("dim", at.alias("shard"), F.lit(False).alias("asks"), "vec_id", "code")
    queries = stored.filter("asked").select("vec_id", "dim", "code").distinct().select(
        "dim", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"),
        F.lit(True).alias("asks"), "vec_id", "code",
    )
    # A shard to each task, whatever its number hashes to.
    task = F.pmod(F.col("shard") + F.pmod(F.xxhash64("dim"), F.lit(shards)), F.lit(shards)).cast("int")
    met = rows.unionByName(queries).repartitionById(shards, task)
    lists = met.sortWithinPartitions("dim", "shard", "asks").mapInArrow(released(_searched(k)), _LISTS)
    return merge_lists(lists, shards, k).select(
        F.col("query_id"), F.posexplode("best").alias("place", "b")
    ).select(
        "query_id", (F.col("place") + 1).cast("int").alias("rank"), "b.vec_id", (-F.col("b.down")).alias("score")
    )
