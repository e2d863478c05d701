"""Queries over versioned history."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import row_hash, row_hash_plain
from ..operators import history as H
from . import bindings as B
from .registry import query

KEYS = ("asset_type", "symbol", "currency", "interval")
_SPLIT = "2024-01-16"
_SHOWN = ("asset_type", "symbol", "ts_utc", "price", "valid_from", "valid_to", "is_current")


def _rows(spark, sf, condition: str):
    """Events as quotes that arrive when they happen."""
    ev = B.table(spark, sf, "events").filter(condition)
    return ev.select(
        F.col("ts").alias("ts_utc"),
        F.col("event_type").alias("asset_type"),
        F.col("user_id").cast("string").alias("symbol"),
        F.lit("spot").alias("interval"),
        F.lit("usd").alias("currency"),
        F.col("value").alias("price"),
        F.col("ts").alias("ingest_ts"),
        "user_id",
    )


def _batches(spark, sf):
    """A history and a batch with new, changed, unchanged and missing keys."""
    old = _rows(spark, sf, f"ts < '{_SPLIT}' AND user_id % 10 <> 0").drop("user_id")
    history = H.scd2_bootstrap(old, KEYS, ["price"])
    known = history.select(*KEYS, F.col("price").alias("_known"))
    new = _rows(spark, sf, f"ts >= '{_SPLIT}' AND user_id % 7 <> 0").join(known, list(KEYS), "left")
    same = F.when(F.col("user_id") % 5 == 1, F.col("_known"))
    incoming = new.withColumn("price", F.coalesce(same, "price")).drop("_known", "user_id")
    return incoming, history


_NEWEST = """
  SELECT event_type AS asset_type, user_id, CAST(user_id AS VARCHAR) AS symbol, ts, "value" AS price
  FROM (SELECT *, row_number() OVER (PARTITION BY event_type, user_id ORDER BY ts DESC) AS rn
        FROM events WHERE {where}) WHERE rn = 1"""
_CTES = f"""
WITH h AS ({_NEWEST.format(where=f"ts < '{_SPLIT}' AND user_id % 10 <> 0")}),
n0 AS ({_NEWEST.format(where=f"ts >= '{_SPLIT}' AND user_id % 7 <> 0")}),
n AS (SELECT n0.asset_type, n0.symbol, n0.ts,
             CASE WHEN n0.user_id % 5 = 1 AND h.price IS NOT NULL THEN h.price
                  ELSE n0.price END AS price
      FROM n0 LEFT JOIN h USING (asset_type, symbol))"""
_CLOSED = """
  SELECT h.asset_type, h.symbol, h.ts AS ts_utc, h.price, h.ts AS valid_from,
         n.ts AS valid_to, FALSE AS is_current
  FROM h JOIN n USING (asset_type, symbol) WHERE h.price <> n.price"""
_OPENED = """
  SELECT n.asset_type, n.symbol, n.ts AS ts_utc, n.price, n.ts AS valid_from,
         CAST(NULL AS TIMESTAMP) AS valid_to, TRUE AS is_current
  FROM n LEFT JOIN h USING (asset_type, symbol) WHERE h.ts IS NULL OR h.price <> n.price"""
_KEPT = """
  SELECT h.asset_type, h.symbol, h.ts AS ts_utc, h.price, h.ts AS valid_from,
         CAST(NULL AS TIMESTAMP) AS valid_to, TRUE AS is_current
  FROM h LEFT JOIN n USING (asset_type, symbol) WHERE n.ts IS NULL OR h.price = n.price"""
_APPLIED = f"{_CTES} {_CLOSED} UNION ALL {_OPENED} UNION ALL {_KEPT}"


@query(f"""
WITH h AS ({_NEWEST.format(where="TRUE")})
SELECT asset_type, symbol, ts AS ts_utc, price, ts AS valid_from,
       CAST(NULL AS TIMESTAMP) AS valid_to, TRUE AS is_current FROM h""")
def scd2_bootstrap(spark, sf):
    rows = _rows(spark, sf, "true")
    return H.scd2_bootstrap(rows, KEYS, ["price"]).select(*_SHOWN)


@query(f"{_CTES} SELECT asset_type, symbol, ts_utc, price, valid_from FROM ({_OPENED})")
def scd2_changed(spark, sf):
    changes = H.scd2_changes(*_batches(spark, sf), KEYS, ["price"])
    opened = changes.filter(F.col(H.CHANGE) == H.OPENED)
    return opened.select("asset_type", "symbol", "ts_utc", "price", "valid_from")


@query(f"{_CTES} {_CLOSED}")
def scd2_closed(spark, sf):
    changes = H.scd2_changes(*_batches(spark, sf), KEYS, ["price"])
    return changes.filter(F.col(H.CHANGE) == H.CLOSED).select(*_SHOWN)


@query(_APPLIED)
def scd2_apply(spark, sf):
    incoming, history = _batches(spark, sf)
    return H.scd2_apply(incoming, history, KEYS, ["price"]).select(*_SHOWN)


@query(_APPLIED)
def scd2_idempotent(spark, sf):
    """The same batch twice leaves what it left once."""
    incoming, history = _batches(spark, sf)
    once = H.scd2_apply(incoming, history, KEYS, ["price"])
    return H.scd2_apply(incoming, once, KEYS, ["price"]).select(*_SHOWN)


@query(f"""
WITH h AS ({_NEWEST.format(where="user_id % 4 <> 0")}),
n AS ({_NEWEST.format(where="ts < '2024-01-08'")})
SELECT asset_type, symbol, ts AS ts_utc, price, ts AS valid_from,
       CAST(NULL AS TIMESTAMP) AS valid_to, TRUE AS is_current
FROM (SELECT asset_type, symbol, ts, price FROM h UNION ALL
      SELECT asset_type, symbol, ts, price FROM n WHERE user_id % 4 = 0)""")
def scd2_late(spark, sf):
    """Rows older than the current version change nothing; new keys still open."""
    history = H.scd2_bootstrap(_rows(spark, sf, "user_id % 4 <> 0"), KEYS, ["price"])
    late = _rows(spark, sf, "ts < '2024-01-08'")
    return H.scd2_apply(late, history, KEYS, ["price"]).select(*_SHOWN)


@query(f"""
WITH s AS (
  {_NEWEST.format(where="ts < '2024-01-11'")} UNION ALL
  {_NEWEST.format(where="ts >= '2024-01-11' AND ts < '2024-01-21'")} UNION ALL
  {_NEWEST.format(where="ts >= '2024-01-21'")}),
d AS (SELECT *, lag(price) OVER (PARTITION BY asset_type, symbol ORDER BY ts) AS before FROM s),
e AS (SELECT *, lead(ts) OVER (PARTITION BY asset_type, symbol ORDER BY ts) AS valid_to
      FROM d WHERE before IS DISTINCT FROM price)
SELECT asset_type, symbol, ts AS ts_utc, price, ts AS valid_from, valid_to,
       valid_to IS NULL AS is_current FROM e""")
def scd2_three_batches(spark, sf):
    """Closed versions of earlier batches are carried along."""
    history = None
    for span in (
        "ts < '2024-01-11'",
        "ts >= '2024-01-11' AND ts < '2024-01-21'",
        "ts >= '2024-01-21'",
    ):
        history = H.scd2_apply(_rows(spark, sf, span), history, KEYS, ["price"])
    return history.select(*_SHOWN)


_CHAIN = """
WITH s AS (SELECT {kind} AS asset_type, {name} AS symbol, ts, "value" AS price,
                  floor("value" / 50) AS level FROM events),
d AS (SELECT *, lag(level) OVER (PARTITION BY asset_type, symbol ORDER BY ts) AS before FROM s),
e AS (SELECT *, lead(ts) OVER (PARTITION BY asset_type, symbol ORDER BY ts) AS valid_to
      FROM d WHERE before IS DISTINCT FROM level)
SELECT asset_type, symbol, ts AS ts_utc, price, ts AS valid_from, valid_to,
       valid_to IS NULL AS is_current FROM e"""


def _with_level(rows):
    return rows.withColumn("level", F.floor(F.col("price") / 50))


@query(_CHAIN.format(kind="event_type", name="CAST(user_id AS VARCHAR)"))
def scd2_all_versions(spark, sf):
    """Every distinct state becomes a version, within and across batches."""
    first = _with_level(_rows(spark, sf, f"ts < '{_SPLIT}'"))
    second = _with_level(_rows(spark, sf, f"ts >= '{_SPLIT}'"))
    history = H.scd2_bootstrap(first, KEYS, ["level"], keep_all_versions=True)
    whole = H.scd2_apply(second, history, KEYS, ["level"], keep_all_versions=True)
    return whole.select(*_SHOWN)


@query(_CHAIN.format(kind="'event'", name="event_type"))
def scd2_all_versions_long(spark, sf):
    """The same for five keys that hold all rows."""
    rows = _rows(spark, sf, "true").withColumn("symbol", F.col("asset_type"))
    rows = _with_level(rows.withColumn("asset_type", F.lit("event")))
    limit = max(rows.count() // 40, 1)
    chain = H.scd2_bootstrap(rows, KEYS, ["level"], keep_all_versions=True, long_series=limit)
    return chain.select(*_SHOWN)


@query("""
SELECT l_suppkey, l_shipdate, l_orderkey, l_linenumber, l_extendedprice, l_quantity FROM (
  SELECT *, row_number() OVER (PARTITION BY l_suppkey, l_shipdate
            ORDER BY l_orderkey DESC, l_linenumber DESC, l_extendedprice DESC, l_quantity DESC) AS rn
  FROM lineitem) WHERE rn = 1""")
def scd2_candle_keys(spark, sf):
    """Newest row per bar, keyed by instant as candle history is."""
    lines = B.table(spark, sf, "lineitem").select(
        "l_suppkey", "l_shipdate", "l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity"
    )
    kept = H.prepare_incoming(
        lines.withColumn("ingest_ts", F.col("l_orderkey")).withColumn(
            "ts_utc", F.col("l_linenumber")
        ),
        ["l_suppkey", "l_shipdate"], ["l_extendedprice"],
    )
    return kept.drop("hash_diff", "ingest_ts", "ts_utc")


_TEXTS = """SELECT event_id, CAST(CAST("value" AS DECIMAL(38, 6)) AS VARCHAR) AS a,
            nullif(event_type, 'error') AS b, props AS c FROM events"""


def _texts(spark, sf):
    return B.table(spark, sf, "events").select(
        "event_id",
        F.col("value").cast("decimal(38,6)").cast("string").alias("a"),
        F.nullif("event_type", F.lit("error")).alias("b"),
        F.col("props").alias("c"),
    )


@query(f"""
SELECT event_id, sha256(coalesce(length(a) || ':' || a, '-') || '|' ||
                        coalesce(length(b) || ':' || b, '-') || '|' ||
                        coalesce(length(c) || ':' || c, '-')) AS hash_diff FROM ({_TEXTS})""")
def row_hashes(spark, sf):
    return _texts(spark, sf).select("event_id", row_hash(["a", "b", "c"]).alias("hash_diff"))


@query(f"""
SELECT event_id, sha256(coalesce(a, '') || '||' || coalesce(b, '') || '||' || coalesce(c, ''))
       AS hash_diff FROM ({_TEXTS})""")
def row_hashes_plain(spark, sf):
    return _texts(spark, sf).select("event_id", row_hash_plain(["a", "b", "c"]).alias("hash_diff"))
