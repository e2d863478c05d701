"""Versioned (SCD type 2) history.

A version is a row plus ``valid_from``, ``valid_to`` (null while current),
``is_current`` and ``hash_diff``.  Applying a batch compares each incoming key
with its current version in one full outer join; closed versions never take
part in it, so a key with a long past does not weigh on the join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import row_hash, wall_clock_utc
from .latest import dedupe_latest
from .series import CHUNK, LONG_SERIES_ROWS, along_series, split_long_series

VERSION_COLUMNS = ("hash_diff", "valid_from", "valid_to", "is_current")
# What happened to a version: kept as it was, closed, or newly opened.
KEPT, CLOSED, OPENED = "kept", "closed", "opened"
CHANGE = "change"
# What becomes of rows that are not newer than the current version of their key.
IGNORE, APPLY, SPLICE = "ignore", "apply", "splice"

_KEY = "_key"


def with_hash(df: DataFrame, tracked: Sequence[str], hasher=row_hash) -> DataFrame:
    """Add ``hash_diff`` over the tracked columns, instants taken in UTC."""

    def plain(name: str) -> Column:
        if isinstance(df.schema[name].dataType, T.TimestampType):
            return wall_clock_utc(F.col(name))
        return F.col(name)

    return df.withColumn("hash_diff", hasher([plain(c) for c in tracked]))


def _opened(df: DataFrame, version_ts: str, valid_to: Column | None = None) -> DataFrame:
    ts_type = df.schema[version_ts].dataType
    valid_to = F.lit(None) if valid_to is None else valid_to
    return df.withColumns(
        {
            "valid_from": F.col(version_ts),
            "valid_to": valid_to.cast(ts_type),
            "is_current": valid_to.isNull(),
        }
    )


def _distinct_versions(
    df: DataFrame, keys: Sequence[str], version_ts: str, long_series: int | None
) -> DataFrame:
    """All versions of each key in time order, repeats of one state merged,
    each valid until the next."""
    rows, df = df, dedupe_latest(df, [*keys, version_ts], newest_by=[version_ts])
    df = split_long_series(df, keys, order=[version_ts], limit=long_series, at_most=rows)

    def changes(part: DataFrame, by: list[str]) -> DataFrame:
        w = Window.partitionBy(*by).orderBy(version_ts)
        return part.withColumn("_before", F.lag("hash_diff").over(w))

    df = along_series(df, keys, 1, changes, order=[version_ts])
    df = df.filter(~F.col("hash_diff").eqNullSafe(F.col("_before"))).drop("_before")

    def successor(part: DataFrame, by: list[str]) -> DataFrame:
        w = Window.partitionBy(*by).orderBy(F.col(version_ts).desc())
        return part.withColumn("_next", F.lag(version_ts).over(w))

    # The next version is the previous one in descending time.
    df = along_series(df, keys, 1, successor, order=[version_ts], ascending=False)
    return df.drop(CHUNK)


def prepare_incoming(
    incoming: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    version_ts: str = "ingest_ts",
    hasher=row_hash,
) -> DataFrame:
    """Keep the newest row per key and hash it."""
    newest = dedupe_latest(incoming, keys, newest_by=[version_ts, "ts_utc"])
    return with_hash(newest, tracked, hasher)


def scd2_bootstrap(
    incoming: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    version_ts: str = "ingest_ts",
    keep_all_versions: bool = False,
    hasher=row_hash,
    long_series: int | None = LONG_SERIES_ROWS,
) -> DataFrame:
    """History made of a first batch alone."""
    if keep_all_versions:
        hashed = with_hash(incoming, tracked, hasher)
        chain = _distinct_versions(hashed, keys, version_ts, long_series)
        return _opened(chain, version_ts, F.col("_next")).drop("_next")
    return _opened(prepare_incoming(incoming, keys, tracked, version_ts, hasher), version_ts)


def is_current() -> Column:
    """Current versions; a null flag counts as closed."""
    return F.coalesce(F.col("is_current"), F.lit(False))


def scd2_compare(
    incoming: DataFrame,
    history: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    version_ts: str = "ingest_ts",
    late: str = IGNORE,
    hasher=row_hash,
    untouched: bool = True,
) -> DataFrame:
    """Current versions after a batch, and those it closes, with a ``change``
    column saying which is which.  Closed versions of ``history`` are left out, and
    without ``untouched`` so are those of keys the batch does not hold.

    ``late="ignore"`` drops rows that are not newer than the current version of
    their key; ``"apply"`` lets them replace it all the same.
    """
    if late not in (IGNORE, APPLY):
        raise ValueError(f"late must be '{IGNORE}' or '{APPLY}', not {late!r}")
    columns = history.columns
    key = F.struct(*keys)  # as a struct, null keys equal each other

    # Deduplicated by the join's own key, the batch is exchanged only once.
    batch = prepare_incoming(incoming.withColumn(_KEY, key), [_KEY], tracked, version_ts, hasher)
    fresh = _opened(batch, version_ts)
    fresh = fresh.select(_KEY, F.struct(*_aligned(fresh, history)).alias("new"))
    # The bare flag, unlike is_current(), reaches the scan; null counts as closed too.
    current = history.filter("is_current").select(key.alias(_KEY), F.struct(*columns).alias("old"))

    has_new, has_old = F.col("new").isNotNull(), F.col("old").isNotNull()
    differs = F.coalesce(F.col("new.hash_diff") != F.col("old.hash_diff"), F.lit(True))
    replaces = has_new & has_old & differs
    if late == IGNORE:
        newer = F.col(f"new.{version_ts}") > F.col(f"old.{version_ts}")
        replaces = replaces & F.coalesce(newer, F.col(f"old.{version_ts}").isNull())

    kept = F.struct(F.lit(KEPT).alias(CHANGE), "old.*")
    opened = F.struct(F.lit(OPENED).alias(CHANGE), "new.*")
    shut = {"valid_to": F.col(f"new.{version_ts}"), "is_current": F.lit(False)}
    closed = F.struct(
        F.lit(CLOSED).alias(CHANGE),
        *(shut.get(c, F.col(f"old.`{c}`")).alias(c) for c in columns),
    )
    outcome = (
        F.when(~has_old, F.array(opened))
        .when(replaces, F.array(closed, opened))
        .otherwise(F.array(kept))
    )
    if untouched:
        joined = current.join(fresh, _KEY, "full_outer")
    else:
        joined = fresh.join(current, _KEY, "left")
    return joined.select(F.inline(outcome))


def _aligned(df: DataFrame, like: DataFrame) -> list[Column]:
    """``df``'s columns in the order and types of ``like``, missing ones null."""
    return [
        (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in like.schema.fields
    ]


def scd2_changes(*args, **options) -> DataFrame:
    """Only the versions a batch closes or opens (see :func:`scd2_compare`)."""
    return scd2_compare(*args, **options, untouched=False).filter(F.col(CHANGE) != KEPT)


def _spliced(
    incoming: DataFrame, stored: DataFrame, keys: Sequence[str], tracked: Sequence[str],
    version_ts: str, late: str, hasher, long_series: int | None,
) -> DataFrame:
    """The chain of versions of each key after every state of a batch took its place.

    Each row has a stored version's columns, with ``_old`` (its former ``valid_from``,
    ``valid_to`` and ``is_current``) where it is one.  A state equal to the one before it
    adds nothing; one equal to the stored version after it moves that one's start.  At an
    instant that has a stored version, that one stands.
    """
    if late not in (IGNORE, SPLICE):
        raise ValueError(f"all versions are kept with late='{IGNORE}' or '{SPLICE}', not {late!r}")
    columns = stored.columns
    plain = stored.drop("valid_from", "valid_to", "is_current")
    hashed = with_hash(incoming, tracked, hasher)
    new = dedupe_latest(hashed.select(*_aligned(hashed, plain)), [*keys, version_ts], [version_ts])
    if late == IGNORE:
        seen = stored.select(F.struct(*keys).alias(_KEY), F.col(version_ts).alias("_seen"))
        new = new.withColumn(_KEY, F.struct(*keys)).join(seen, _KEY, "left").filter(
            F.col("_seen").isNull() | (F.col(version_ts) > F.col("_seen"))
        ).drop(_KEY, "_seen")
    else:
        taken = stored.select(F.struct(*keys, F.col("valid_from").alias("at")).alias(_KEY))
        new = new.withColumn(_KEY, F.struct(*keys, F.col(version_ts).alias("at"))).join(
            taken, _KEY, "left_anti"
        ).drop(_KEY)
    old = F.struct("valid_from", "valid_to", "is_current")
    no_old = F.lit(None).cast(stored.select(old.alias("o")).schema["o"].dataType)
    rows = stored.withColumn("_old", old).withColumn("_since", F.col("valid_from")).drop(
        "valid_from", "valid_to", "is_current"
    ).unionByName(new.withColumn("_old", no_old).withColumn("_since", F.col(version_ts)))

    order = ["_since", "hash_diff"]
    state = F.struct("hash_diff", "_since", F.col("_old").isNotNull().alias("stored"))

    def neighbour(name: str, ascending: bool):
        def compute(part: DataFrame, by: list[str]) -> DataFrame:
            turn = [F.col(c).asc() if ascending else F.col(c).desc() for c in order]
            return part.withColumn(name, F.lag(state).over(Window.partitionBy(*by).orderBy(*turn)))

        return compute

    def along(part: DataFrame, name: str, ascending: bool = True) -> DataFrame:
        return along_series(part, keys, 1, neighbour(name, ascending), order, ascending)

    def same(name: str) -> Column:
        return F.col("hash_diff").eqNullSafe(F.col(f"{name}.hash_diff")) & F.col(name).isNotNull()

    rows = split_long_series(rows, keys, order=order, limit=long_series)
    fresh = F.col("_old").isNull()
    rows = along(rows, "_before").filter(~(fresh & same("_before"))).drop("_before")
    rows = along(along(rows, "_before"), "_after", ascending=False)
    moved = ~fresh & same("_before") & ~F.col("_before.stored")
    absorbed = fresh & same("_after") & F.col("_after.stored")
    rows = rows.withColumn("_since", F.when(moved, F.col("_before._since")).otherwise(F.col("_since")))
    rows = along(rows.filter(~absorbed).drop("_before", "_after"), "_after", ascending=False)
    rows = rows.withColumn("_to", F.col("_after._since"))
    chain = _opened(rows, version_ts, F.col("_to")).withColumn("valid_from", F.col("_since"))
    return chain.select(*columns, "_old")


def splice_changes(
    incoming: DataFrame, history: DataFrame, keys: Sequence[str], tracked: Sequence[str],
    version_ts: str = "ingest_ts", late: str = IGNORE, hasher=row_hash,
    long_series: int | None = LONG_SERIES_ROWS,
) -> DataFrame:
    """Versions that a batch opens, or whose bounds it changes, when every distinct state
    of it becomes a version.

    ``change`` says which; ``_from`` is the ``valid_from`` a changed version had, ``_was``
    whether it was current.  Only versions of the batch's keys take part, and with
    ``late="ignore"`` only current ones.
    """
    base = history.filter("is_current") if late == IGNORE else history
    touched = incoming.select(F.struct(*keys).alias(_KEY)).distinct()
    stored = base.withColumn(_KEY, F.struct(*keys)).join(touched, _KEY, "left_semi").drop(_KEY)
    chain = _spliced(incoming, stored, keys, tracked, version_ts, late, hasher, long_series)
    kept = F.lit(True)
    for c in ("valid_from", "valid_to", "is_current"):
        kept = kept & F.col(c).eqNullSafe(F.col(f"_old.{c}"))
    change = F.when(F.col("_old").isNull(), OPENED).when(~kept, CLOSED)
    return chain.withColumns({
        CHANGE: change, "_from": F.col("_old.valid_from"),
        "_was": F.coalesce(F.col("_old.is_current"), F.lit(False)),
    }).filter(F.col(CHANGE).isNotNull()).drop("_old")


def scd2_apply(
    incoming: DataFrame,
    history: DataFrame | None,
    keys: Sequence[str],
    tracked: Sequence[str],
    version_ts: str = "ingest_ts",
    late: str = IGNORE,
    keep_all_versions: bool = False,
    hasher=row_hash,
    long_series: int | None = LONG_SERIES_ROWS,
) -> DataFrame:
    """The whole history after a batch; ``history=None`` starts one.

    A key absent from the batch stays current.  Applying a batch twice equals
    applying it once.  With ``keep_all_versions`` every distinct state within
    the batch becomes a version; otherwise only the newest row per key does.

    Rows not newer than the current version of their key are dropped with
    ``late="ignore"``.  ``"apply"`` lets the newest of them replace that version all the
    same; ``"splice"``, for ``keep_all_versions`` alone, puts each where it belongs in
    time, splitting the version that was valid then.
    """
    if keep_all_versions and late == APPLY:
        raise ValueError("keep_all_versions needs late='ignore' or late='splice'")
    if history is None:
        return scd2_bootstrap(
            incoming, keys, tracked, version_ts, keep_all_versions, hasher, long_series
        )
    columns = history.columns
    past = history.filter(~is_current()).withColumn("is_current", F.lit(False))
    if not keep_all_versions:
        now = scd2_compare(incoming, history, keys, tracked, version_ts, late, hasher)
        return past.unionByName(now.drop(CHANGE)).select(*columns)
    stored = history.filter(is_current()) if late == IGNORE else history
    chain = _spliced(incoming, stored, keys, tracked, version_ts, late, hasher, long_series)
    return (past.unionByName(chain.drop("_old")) if late == IGNORE else chain).select(*columns)
