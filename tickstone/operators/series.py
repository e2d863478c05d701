"""Windows along a time series that stay parallel when one series is huge.

A plain ``Window.partitionBy(series)`` puts a whole series into one task. That
is the right plan while series are of ordinary length, and the wrong one when a
single series holds a large part of the table.  So:

* :func:`split_long_series` counts rows per series (one aggregation over the
  key columns).  If no series is over the limit, the frame is returned as it
  is and every window is the plain one: a single exchange.
* Otherwise the long series, and only those, are range-partitioned by
  (series, time) into chunks of about the limit's size.
* :func:`along_series` then windows by (series, chunk).  Each chunk is handed
  copies of the ``lookback`` rows that precede it, so a row sees exactly the
  neighbours it would see in the undivided series; the copies are dropped
  afterwards.  Nothing is sampled or cut: results equal the plain window's.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scratch import materialise

# A task sorts this many rows of a series comfortably (some hundred MB).
LONG_SERIES_ROWS = 2_000_000
# Above this many long series their list is joined instead of broadcast
# (100,000 keys are a few MB).
BROADCAST_SERIES = 100_000

# The rows per key up to which Spark cuts before the exchange
# (``spark.sql.optimizer.windowGroupLimitThreshold``).
MAP_SIDE_ROWS = 1000

CHUNK = "_chunk"
_COPY = "_copy"
_KEY = "_series"

Compute = Callable[[DataFrame, list[str]], DataFrame]


def split_long_series(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str] = ("ts_utc",),
    limit: int | None = LONG_SERIES_ROWS,
    at_most: DataFrame | None = None,
) -> DataFrame:
    """Tag rows with the chunk of their series, if any series needs chunks.

    ``limit=None`` is for callers that know their series are short, such as
    one row per calendar day.  ``at_most`` is a frame that is cheaper to count
    and has no fewer rows of any series; ``df`` itself is counted only if that
    one shows long series.
    """
    if limit is None or CHUNK in df.columns:
        return df
    key = F.struct(*keys).alias(_KEY)  # a struct compares nulls as equal
    for counted in (df,) if at_most is None else (at_most, df):
        sizes = counted.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
        long = sizes.filter(F.col("_rows") > limit)
        found = long.agg(F.count(F.lit(1)).alias("n"), F.sum("_rows").alias("total")).first()
        if not found["n"]:
            return df

    long = materialise(long.select(_KEY))
    if found["n"] <= BROADCAST_SERIES:
        long = F.broadcast(long)
    keyed = df.withColumn(_KEY, key)
    short_rows = keyed.join(long, _KEY, "left_anti").withColumn(CHUNK, F.lit(-1))
    # Chunk numbers come from sampled range borders, which differ between two
    # runs of the same plan; writing them down makes every branch agree.
    chunks = -(-found["total"] // limit) + found["n"]
    long_rows = materialise(
        keyed.join(long, _KEY, "left_semi")
        .repartitionByRange(int(chunks), *keys, *order)
        .withColumn(CHUNK, F.spark_partition_id())
    )
    return short_rows.unionByName(long_rows).drop(_KEY)


def along_series(
    df: DataFrame,
    keys: Sequence[str],
    lookback: int,
    compute: Compute,
    order: Sequence[str] = ("ts_utc",),
    ascending: bool = True,
) -> DataFrame:
    """Run ``compute(df, partition_columns)``, which adds windowed columns.

    ``compute`` must window by the given columns in the given ``order``, look
    back at most ``lookback`` rows, and keep every row and column it was given.
    """
    keys = list(keys)
    if CHUNK not in df.columns:
        return compute(df, keys)

    oldest_first = [F.col(c).asc() if ascending else F.col(c).desc() for c in order]
    newest_first = [F.col(c).desc() if ascending else F.col(c).asc() for c in order]
    last = Window.partitionBy(*keys, CHUNK).orderBy(*newest_first)
    tails = (
        df.filter(F.col(CHUNK) >= 0)
        .withColumn("_back", F.row_number().over(last))
        .filter(F.col("_back") <= lookback)
        .drop("_back")
    )
    # A tail row precedes a later chunk closely enough to matter exactly when
    # that chunk has a row among the next ``lookback`` tail rows.
    ahead = Window.partitionBy(*keys).orderBy(*oldest_first).rowsBetween(1, lookback)
    copies = (
        tails.withColumn("_to", F.collect_set(CHUNK).over(ahead))
        .withColumn("_to", F.explode("_to"))
        .filter(F.col("_to") != F.col(CHUNK))
        .withColumn(CHUNK, F.col("_to"))
        .drop("_to")
        .withColumn(_COPY, F.lit(True))
    )
    whole = df.withColumn(_COPY, F.lit(False)).unionByName(copies)
    return compute(whole, keys + [CHUNK]).filter(~F.col(_COPY)).drop(_COPY)


def newest_per_key(
    df: DataFrame, keys: Sequence[str], newest_first: Sequence[Column], k: int = 1,
    long_series: int | None = LONG_SERIES_ROWS,
) -> DataFrame:
    """The ``k`` first rows per key.

    Spark cuts each map task's rows to ``k`` per key before the exchange, so a key with
    very many copies does not load one task.  It does so for ``k`` up to a thousand.
    For more, keys are counted, and if one has over ``long_series`` rows, all keys are
    first cut to ``k`` rows in each of so many parts that a part of the longest stays
    below that; what is left is cut again in the same way.  ``long_series=None`` says
    that no key is that long.
    """
    w = Window.partitionBy(*keys).orderBy(*newest_first)
    if k > MAP_SIDE_ROWS and long_series is not None:
        key = F.struct(*keys)
        sizes = df.groupBy(key.alias(_KEY)).agg(F.count(F.lit(1)).alias("_rows"))
        most = sizes.agg(F.max("_rows").alias("most")).first()["most"] or 0
        while most > long_series and -(-most // long_series) * k < most:
            parts = -(-most // long_series)
            # By the row's values and its task, so that copies of a row are dealt out too
            # and a repeated task deals them alike.
            part = F.pmod(F.xxhash64(*df.columns, F.spark_partition_id()), F.lit(parts))
            cut = Window.partitionBy(*keys, "_part").orderBy(*newest_first)
            df = df.withColumn("_part", part).withColumn("_rn", F.row_number().over(cut)).filter(
                F.col("_rn") <= k
            ).drop("_part", "_rn")
            most = parts * k
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= k).drop("_rn")
