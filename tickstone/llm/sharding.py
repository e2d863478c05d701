"""Shards of nearly equal bytes from an ordered list of groups that stay whole.

Groups (equal texts) stand in the order of their smallest id and are cut into
contiguous runs so that the largest run is as small as possible.  The smallest
feasible capacity is found by binary search; a capacity is feasible if filling each
shard greedily to at most that many bytes uses no more than the shards there are.

The running totals of all groups stay in a table of sorted blocks; the driver holds
one row per block.  One greedy step asks for the last running total not above a
bound, which lies in a single known block, so a check reads few blocks.  Eight
halvings are taken at once: the 255 capacities they could visit are checked together,
sixteen small look-ups for all of them.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.scratch import scratch_path

SHARDS = 16
#: Capacities checked together: what eight halvings can visit.
_AT_ONCE = 255
#: Parts of a group, so that numbering a hot group's rows is spread over tasks.
PARTS = 1024


def _facts(spark: SparkSession, rows: list[tuple], names: Sequence[str]) -> DataFrame:
    """A few rows of whole numbers as literals of the plan."""
    columns = [F.lit([int(r[k]) for r in rows]).cast("array<bigint>").alias(n) for k, n in enumerate(names)]
    return spark.range(1).select(F.inline(F.arrays_zip(*columns)))


def _stored(df: DataFrame, label: str, *by: str) -> DataFrame:
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", "snappy").partitionBy(*by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sized(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``size`` (bytes of UTF-8 plus one), ``text_crc32``, the group's
    ``key`` (null for a null text) and the row's ``part`` of its group."""
    t = F.col(text).cast("binary")
    return docs.select(
        F.col(doc_id).alias("doc_id"),
        (F.coalesce(F.octet_length(t), F.lit(0)) + 1).cast("bigint").alias("size"),
        F.crc32(F.coalesce(t, F.lit(b""))).alias("text_crc32"),
        F.unhex(F.sha2(t, 256)).alias("key"),
        F.pmod(F.xxhash64(F.col(doc_id)), F.lit(PARTS)).cast("int").alias("part"),
    )


class _Totals:
    """Running totals of ordered groups, in blocks of a table."""

    def __init__(self, groups: DataFrame, blocks: int):
        ordered = groups.repartitionByRange(blocks, "first_id", "key").withColumn(
            "block", F.spark_partition_id()
        )
        self.groups = _stored(ordered, "groups", "block")
        per_block = self.groups.groupBy("block").agg(
            F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows"), F.max("bytes").alias("most")
        ).orderBy("block").collect()  # a row per block
        self.blocks, self.ends, before, rows = [], [], {}, 0
        total = 0
        for b in per_block:
            before[b["block"]] = (total, rows)
            total, rows = total + b["bytes"], rows + b["rows"]
            self.blocks.append(b["block"])
            self.ends.append(total)
        self.total, self.rows = total, rows
        self.most = max((b["most"] for b in per_block), default=0)
        order = F.col("first_id").asc_nulls_first(), F.col("key").asc_nulls_first()
        w = Window.partitionBy("block").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        starts = _facts(
            groups.sparkSession, [(k, *v) for k, v in before.items()],
            ["at", "bytes_before", "rows_before"],
        )
        self.running = _stored(
            self.groups.join(F.broadcast(starts), F.col("block") == F.col("at")).select(
                "key", "block", "rows",
                (F.sum("bytes").over(w) + F.col("bytes_before")).alias("upto"),
                (F.sum("rows").over(w) + F.col("rows_before")).alias("rows_upto"),
            ), "totals", "block",
        )

    def last_within(self, bounds: list[int]) -> dict[int, int]:
        """For each bound the last running total not above it; 0 if there is none."""
        out, asked = {}, {}
        for b in set(bounds):
            k = bisect_right(self.ends, b)  # blocks wholly within the bound
            out[b] = self.ends[k - 1] if k else 0
            if k < len(self.ends):
                asked[b] = self.blocks[k]
        if asked:
            ask = _facts(self.running.sparkSession, list(asked.items()), ["bound", "at"])
            near = self.running.filter(F.col("block").isin(sorted(set(asked.values()))))
            hits = near.join(
                F.broadcast(ask), (F.col("block") == F.col("at")) & (F.col("upto") <= F.col("bound"))
            )  # at most 255 bounds, each meets the groups of one block
            for r in hits.groupBy("bound").agg(F.max("upto").alias("upto")).collect():
                out[r["bound"]] = max(out[r["bound"]], r["upto"])
        return out

    def cuts(self, capacities: list[int], shards: int) -> dict[int, list[int]]:
        """Where greedy filling cuts, for each capacity."""
        at = {c: [0] for c in capacities}
        for _ in range(shards):
            going = [c for c in capacities if at[c][-1] < self.total]
            if not going:
                break
            found = self.last_within([at[c][-1] + c for c in going])
            for c in going:
                at[c].append(found[at[c][-1] + c])
        return {c: x[1:] for c, x in at.items()}


def smallest_capacity(totals: _Totals, shards: int) -> tuple[int, list[int]]:
    """The smallest feasible capacity and its cuts (the last is the total)."""
    low = max(-(-totals.total // shards), totals.most)
    high = low + totals.most  # greedy shards hold more than a fair share, so this fits
    best: list[int] = []
    while True:
        step = max(1, -(-(high - low) // _AT_ONCE))
        tried = sorted({min(high, low + k * step) for k in range(_AT_ONCE + 1)})
        cuts = totals.cuts(tried, shards)
        fits = [c for c in tried if cuts[c] and cuts[c][-1] == totals.total]
        high, best = fits[0], cuts[fits[0]]
        below = [c for c in tried if c < high]
        if not below or below[-1] + 1 == high:
            return high, best
        low = below[-1] + 1


def shard(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shards: int = SHARDS,
    blocks: int | None = None,
) -> DataFrame:
    """One row per row: ``doc_id, size, text_crc32, law, shard, slot, grown_shard``.

    Equal texts share a shard; null texts are one group and empty texts another.
    ``slot`` numbers a shard's rows from 0 without gaps, by group, part of the group
    and id.  Repeated rows get a slot each.  An empty table gives no rows.  Fewer
    groups than shards leave the last shards empty.  ``grown_shard`` is null, as the
    law is ``bytes``.  Groups are sorted in ``blocks`` parts, by default as many as
    a shuffle has; the driver holds a row for each.
    """
    blocks = blocks or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = _stored(sized(docs, doc_id, text).withColumn("_p", F.lit(0)), "sized", "_p").drop("_p")
    parts = rows.groupBy("key", "part").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("size").alias("bytes"), F.min("doc_id").alias("first_id")
    )
    w = Window.partitionBy("key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = _stored(
        parts.withColumn("in_group", F.coalesce(F.sum("rows").over(w), F.lit(0))).withColumn("_p", F.lit(0)),
        "parts", "_p",
    ).drop("_p")
    groups = parts.groupBy("key").agg(
        F.sum("rows").alias("rows"), F.sum("bytes").alias("bytes"), F.min("first_id").alias("first_id")
    )
    totals = _Totals(groups, blocks)
    cuts = smallest_capacity(totals, shards)[1] if totals.total else []
    number = F.lit(len(cuts) - 1)
    for k in range(len(cuts) - 2, -1, -1):
        number = F.when(F.col("upto") <= cuts[k], F.lit(k)).otherwise(number)
    placed = totals.running.select(
        "key", number.cast("int").alias("shard"), (F.col("rows_upto") - F.col("rows")).alias("before")
    )
    starts = {r["shard"]: r["b"] for r in placed.groupBy("shard").agg(F.min("before").alias("b")).collect()}
    base = F.lit(0).cast("bigint")
    for k, b in starts.items():
        base = F.when(F.col("shard") == k, F.lit(b)).otherwise(base)
    placed = placed.select("key", "shard", (F.col("before") - base).alias("before"))
    p = parts.select("key", "part", "in_group").alias("p")
    g = placed.withColumnRenamed("key", "g_key")
    places = p.join(g, F.col("key").eqNullSafe(F.col("g_key"))).select(
        "key", "part", "shard", (F.col("before") + F.col("in_group")).alias("from_slot")
    )
    in_part = Window.partitionBy("key", "part").orderBy(F.col("doc_id").asc_nulls_first())
    numbered = rows.withColumn("nth", F.row_number().over(in_part) - 1)
    places = places.select(
        F.col("key").alias("k"), F.col("part").alias("q"), "shard", "from_slot"
    )
    met = F.col("key").eqNullSafe(F.col("k")) & (F.col("part") == F.col("q"))
    return numbered.join(places, met).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("from_slot") + F.col("nth")).cast("bigint").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
