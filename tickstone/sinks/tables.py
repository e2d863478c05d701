"""Writing partitioned tables.

Rows go to their folders in one write: Spark collects the new files beside the table and
moves them into place when all tasks are done.  Only where a table is also an input are
its new partitions stored apart first, so that a job lost while files are moved can be
replayed; that copy goes when the write is done.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import not_blank, row_hash, wall_clock_utc
from ..functions.scratch import remove, workspace
from ..operators.history import (
    CHANGE,
    CLOSED,
    IGNORE,
    OPENED,
    SPLICE,
    is_current,
    scd2_bootstrap,
    scd2_changes,
    splice_changes,
)
from ..operators.latest import dedupe_latest
from ..sources.files import read_table

# Up to so many values of a partition column are named in a filter, which prunes folders
# one by one; beyond, their range does.
NAMED_VALUES = 1000


def _storable(df: DataFrame, partitions: Sequence[str]) -> DataFrame:
    # A folder name cannot tell null from empty text; both come back as null.
    names = {p: F.coalesce(not_blank(F.col(p)), F.lit(S.UNKNOWN)) for p in partitions}
    return df.withColumns(names)


def write_partitioned(
    df: DataFrame, path: str, partitions: Sequence[str] = S.PARTITIONS, whole: bool = False,
    from_itself: bool = True,
) -> int:
    """Replace the partitions ``df`` has rows for, or with ``whole`` all of the table;
    returns the rows written.

    ``df`` may derive from the table at ``path``; with ``from_itself=False`` the caller
    says that it does not, which saves a copy.
    """
    df = _storable(df, partitions)
    if not from_itself:
        return _write(df, path, partitions, whole)
    with workspace(df.sparkSession) as work:
        staged, rows = work.store(df)
        if not rows and not whole:
            return 0
        if _write(staged, path, partitions, whole) != rows:
            raise RuntimeError(f"{path}: {rows} rows staged, another number written")
    return rows


def _write(df: DataFrame, path: str, partitions: Sequence[str], whole: bool = False) -> int:
    """One write.  Rebalancing brings a folder's rows together, lets small folders share
    a task and gives a huge one several, by the sizes the shuffle finds."""
    known, written = read_table(df.sparkSession, path, df.schema) is not None, Observation()
    (
        df.hint("rebalance", *partitions)
        # Behind the exchange, so that it is also counted when that finds no rows.
        .observe(written, F.count(F.lit(1)).alias("rows"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static" if whole else "dynamic")
        .option("compression", "snappy")
        .partitionBy(*partitions)
        .parquet(path)
    )
    rows = written.get["rows"]
    if not rows and not known:
        remove(df.sparkSession, path)  # nothing written makes no table
    return rows


def _holding(df: DataFrame, column: str, wanted: DataFrame) -> DataFrame:
    """Stored rows whose partition value is among those of a column of ``wanted``, or at
    least in their range; either way only such folders are read."""
    if column not in wanted.columns or column not in df.columns:
        return df
    named = [r[0] for r in wanted.select(column).distinct().limit(NAMED_VALUES + 1).collect()]
    if len(named) <= NAMED_VALUES:
        return df.filter(F.col(column).isin(named))
    span = wanted.agg(F.min(column).alias("lo"), F.max(column).alias("hi")).first()
    return df.filter(F.col(column).between(span["lo"], span["hi"]))


def in_partitions_of(
    df: DataFrame, touched: DataFrame, partitions: Sequence[str] = S.PARTITIONS
) -> DataFrame:
    """The rows of a stored table that share a partition with ``touched``."""
    parts = touched.select(*partitions).distinct()
    listed = parts.limit(NAMED_VALUES + 1).collect()
    if len(listed) <= NAMED_VALUES:  # few: named in filters, and found only once
        parts = df.sparkSession.createDataFrame(listed, parts.schema)
        for k, column in enumerate(partitions):
            df = df.filter(F.col(column).isin(sorted({r[k] for r in listed})))
    else:
        for column in partitions:
            df = _holding(df, column, parts)
    # The values prune folders; the join settles the rest exactly.
    return df.join(parts, list(partitions), "left_semi")


def upsert(
    df: DataFrame,
    path: str,
    schema,
    keys: Sequence[str],
    partitions: Sequence[str] = S.PARTITIONS,
    stored: bool = False,
) -> int:
    """Merge rows into a table: the newest row per key stays, and rows of other
    sources in the same partition survive.  Returns the rows of the partitions
    rewritten.

    Rows of a new table are written once.  Otherwise ``df`` is read several times and is
    stored first, unless the caller says that it is ``stored`` already.
    """
    fresh = _storable(df.select(*schema.fieldNames()), partitions)
    old = read_table(df.sparkSession, path, schema)
    if old is None:
        return _write(dedupe_latest(fresh, keys), path, partitions)
    with workspace(df.sparkSession) as work:
        if not stored:
            fresh, rows = work.store(dedupe_latest(fresh, keys))
            if not rows:
                return 0
        merged = in_partitions_of(old, fresh, partitions).unionByName(fresh)
        staged, rows = work.store(dedupe_latest(merged, keys))
        return _write(staged, path, partitions) if rows else 0


def apply_versions(
    incoming: DataFrame,
    path: str,
    schema,
    keys: Sequence[str],
    tracked: Sequence[str],
    partitions: Sequence[str] = S.PARTITIONS,
    version_ts: str = "ingest_ts",
    late: str = IGNORE,
    keep_all_versions: bool = False,
    hasher=row_hash,
) -> dict[str, int]:
    """Apply a batch to a stored history; returns versions opened and closed.

    Only the versions that the batch opens, closes or displaces are staged, and only the
    partitions they lie in are rewritten.  Of the history, the current versions under the
    batch's partition values are read, with ``late="splice"`` also the closed ones.
    See :func:`~tickstone.operators.history.scd2_apply` for the options.
    """
    if keep_all_versions and late not in (IGNORE, SPLICE):
        raise ValueError("keep_all_versions needs late='ignore' or late='splice'")
    columns = schema.fieldNames()
    # Keys are compared as they are stored, so a null name meets its stored stand-in.
    incoming = _storable(incoming, partitions)
    history = read_table(incoming.sparkSession, path, schema)
    if history is None:
        first = scd2_bootstrap(incoming, keys, tracked, version_ts, keep_all_versions, hasher)
        return {OPENED: _write(first.select(*columns), path, partitions), CLOSED: 0}
    known = history
    for column in partitions:
        # A key's versions share its own partition values; where the key holds the time,
        # they share the day too.
        if column in keys or (column == "date" and "ts_utc" in keys):
            known = _holding(known, column, incoming)
    with workspace(incoming.sparkSession) as work:
        if keep_all_versions:
            found = splice_changes(incoming, known, keys, tracked, version_ts, late, hasher)
        else:
            found = scd2_changes(incoming, known, keys, tracked, version_ts, late, hasher)
        changes, rows = work.store(_storable(found, partitions))
        if not rows:
            return {OPENED: 0, CLOSED: 0}
        counts = {r[CHANGE]: r["count"] for r in changes.groupBy(CHANGE).count().collect()}
        around = in_partitions_of(history, changes, partitions)
        if not keep_all_versions:  # only current versions are closed, and keep their start
            changes = changes.withColumns({"_was": F.lit(True), "_from": F.col("valid_from")})
        replaced = changes.filter(F.col(CHANGE) != OPENED).select(
            _version(keys, F.col("_from"), F.col("_was"))
        )
        rest = around.withColumn("_version", _version(keys, F.col("valid_from"), is_current())).join(
            replaced, "_version", "left_anti"
        )
        staged, _ = work.store(rest.select(*columns).unionByName(changes.select(*columns)))
        _write(staged, path, partitions)
    return {OPENED: counts.get(OPENED, 0), CLOSED: counts.get(CLOSED, 0)}


def _version(keys: Sequence[str], start: Column, was_current: Column) -> Column:
    """What tells a stored version from all others."""
    return F.struct(
        *keys, start.alias("start"), "hash_diff", was_current.alias("current")
    ).alias("_version")


def write_predictions(predictions: DataFrame, path: str) -> None:
    """Predictions as JSON lines with the time they were made."""
    now = F.date_format(
        wall_clock_utc(F.current_timestamp()), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'"
    )
    predictions.withColumn("generated_at", now).write.mode("overwrite").json(path)


def write_predictions_document(predictions: DataFrame, path: str) -> None:
    """Predictions as one document, ``{"generated_at": …, "predictions": […]}``.

    The document is one value, so this is for as many series as one task can hold;
    :func:`write_predictions` has no such bound.
    """
    fields = S.PREDICTIONS_DOCUMENT["predictions"].dataType.elementType.fieldNames()
    now = F.date_format(
        wall_clock_utc(F.current_timestamp()), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'"
    )
    one = predictions.agg(
        now.alias("generated_at"), F.sort_array(F.collect_list(F.struct(*fields))).alias("predictions")
    )
    one.coalesce(1).write.mode("overwrite").json(path)
