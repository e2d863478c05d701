"""Queries over the payload parsers."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import number
from ..functions.scratch import materialise
from ..operators import payloads
from ..operators.latest import dedupe_latest
from . import bindings as B
from .registry import query


def _epoch(df):
    """Instants as epoch microseconds, free of any session zone."""
    return df.withColumn("ts_us", F.unix_micros("ts_utc")).drop("ts_utc", "ingest_ts")


_SPOT_SQL = """
  SELECT epoch_us(ts) AS ts_us, strftime(ts, '%Y-%m-%d') AS "date", 'crypto' AS asset_type,
         CAST(user_id AS VARCHAR) AS symbol, 'spot' AS "interval", cur AS currency,
         "value" * k AS price, 'coingecko' AS source,
         'crypto_simple_price-' || strftime(ts, '%Y%m%d') AS run_id
  FROM events, (VALUES ('usd', 1), ('eur', 2)) m(cur, k)"""
_HISTORY_SQL = """
  SELECT (epoch_us(ts) // 1000) * 1000 + d * 86400000000 AS ts_us,
         strftime(ts + INTERVAL 1 DAY * d, '%Y-%m-%d') AS "date", 'crypto' AS asset_type,
         CAST(user_id AS VARCHAR) AS symbol, '1d' AS "interval", 'usd' AS currency,
         "value" * (d + 1) AS price, 'coingecko_market_chart' AS source,
         'crypto_market_chart-' || strftime(ts, '%Y%m%d') AS run_id
  FROM events, (VALUES (0), (1)) m(d)"""
_FX_SQL = """
  SELECT epoch_us(date_trunc('day', ts)) AS ts_us, strftime(ts, '%Y-%m-%d') AS "date",
         'forex' AS asset_type, 'EUR' || cur AS symbol, '1d' AS "interval", cur AS currency,
         "value" * k AS price, 'frankfurter' AS source,
         'forex_latest-' || strftime(ts, '%Y%m%d') AS run_id
  FROM events, (VALUES ('USD', 1), ('GBP', 2)) m(cur, k)"""


@query(_SPOT_SQL)
def parse_spot_map(spark, sf):
    return _epoch(payloads.parse_spot_map(B.spot_responses(spark, sf)))


@query(_HISTORY_SQL)
def parse_history_pairs(spark, sf):
    return _epoch(payloads.parse_history_pairs(B.history_responses(spark, sf)))


@query(_FX_SQL)
def parse_fx_rates(spark, sf):
    return _epoch(payloads.parse_fx_rates(B.fx_responses(spark, sf)))


@query("""
  SELECT epoch_us(l_shipdate) AS ts_us, strftime(l_shipdate, '%Y-%m-%d') AS "date",
         'stock' AS asset_type,
         CASE WHEN l_linenumber % 3 < 2 THEN CAST(l_suppkey AS VARCHAR) ELSE 'BRK B' END AS symbol,
         '1day' AS "interval", l_extendedprice AS "open", l_extendedprice * 2 AS high,
         CAST(NULL AS DOUBLE) AS low, l_extendedprice AS "close",
         CASE WHEN l_linestatus = 'O' THEN l_quantity END AS volume, 'USD' AS currency,
         'twelvedata' AS source, 'time_series-' || strftime(l_shipdate, '%Y%m%d') AS run_id
  FROM lineitem WHERE l_returnflag <> 'R'""")
def parse_candles(spark, sf):
    return _epoch(payloads.candles(B.candle_responses(spark, sf)))


# --- time and number text in every form ------------------------------------

# A form of time text per event: its pattern, and what it means in SQL (null: refused).
_TIMES = [
    ("yyyy", "date_trunc('year', ts)"),
    ("yyyy-MM", "date_trunc('month', ts)"),
    ("yyyy-MM-dd", "date_trunc('day', ts)"),
    ("' 'yyyy-MM-dd' '", "date_trunc('day', ts)"),
    ("yyyy-MM-dd HH", "date_trunc('hour', ts)"),
    ("yyyy-MM-dd'T'HH", "date_trunc('hour', ts)"),
    ("yyyy-MM-dd HH:mm", "date_trunc('minute', ts)"),
    ("yyyy-MM-dd'T'HH:mm:ss", "date_trunc('second', ts)"),
    ("yyyy-M-d H:m:s", "date_trunc('second', ts)"),
    ("yyyy-MM-dd HH:mm:ss.SSSSSS", "ts"),
    ("yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'", "ts"),
    ("yyyy-MM-dd'T'HH:mm:ss'+02:00'", "date_trunc('second', ts) - INTERVAL 2 HOUR"),
    ("yyyy-MM-dd'T'HH:mm'-05:30'", "date_trunc('minute', ts) + INTERVAL 330 MINUTE"),
    ("yyyy-MM-dd HH:mm:ss' Asia/Tokyo'", "date_trunc('second', ts) - INTERVAL 9 HOUR"),
    ("yyyy-MM-dd HH:mm:ss'UTC+03:00'", "date_trunc('second', ts) - INTERVAL 3 HOUR"),
    ("yyyy-MM-dd'T'", "NULL"),
    ("HH:mm:ss", "NULL"),
    ("HH:mm'Z'", "NULL"),
    ("yyyy-'13'-dd", "NULL"),
    ("'soon 'yyyy-MM-dd", "NULL"),
    ("yyyy-MM-dd HH:mm:ss'N'", "NULL"),
]
# Likewise number text: a prefix and a suffix of the value, or a text of its own.
_NUMBERS = [
    ("", "", True), (" ", "\t", True), ("", "e2", True), ("-", "", True), ("+", "", True),
    ("", "abc", False), ("", "d", False), ("", " 1", False), ("0x", "", False),
]
_OTHER_NUMBERS = [("", None), ("NaN", None), ("Infinity", None), ("1e400", None), (".5", 0.5), ("1e308", 1e308)]


def _one_bar_per_event(spark, sf, datetime, number_text):
    """Candle responses of one bar, the event's id as symbol."""
    bar = F.struct(
        datetime.alias("datetime"), *(number_text.alias(c) for c in ("open", "high", "low", "close")),
        F.lit(None).cast("string").alias("volume"),
    )
    meta = F.struct(F.col("event_id").cast("string").alias("symbol"), F.lit("USD").alias("currency"))
    data = F.to_json(F.struct(F.lit("ok").alias("status"), meta.alias("meta"), F.array(bar).alias("values")))
    events = B.table(spark, sf, "events")
    return payloads.candles(B.responses(events, S.SOURCE_CANDLES, "time_series", data))


def _choice(forms, kind):
    """The form whose place is the event's id modulo their number."""
    place, chosen = F.col("event_id") % len(forms), F.lit(None).cast(kind)
    for k, form in enumerate(forms):
        chosen = F.when(place == k, form).otherwise(chosen)
    return chosen


@query(f"""
  SELECT event_id, epoch_us(moment) AS ts_us, strftime(moment, '%Y-%m-%d') AS "date" FROM (
    SELECT event_id, CASE event_id % {len(_TIMES)}
      {" ".join(f"WHEN {k} THEN {sql}" for k, (_, sql) in enumerate(_TIMES))} END AS moment FROM events)
  WHERE moment IS NOT NULL""")
def parse_edge_times(spark, sf):
    """Time text from a bare year to a named zone, and text that is no time."""
    text = _choice([F.date_format("ts", pattern) for pattern, _ in _TIMES], "string")
    rows = _one_bar_per_event(spark, sf, text, F.lit("1"))
    return _epoch(rows).select(F.col("symbol").cast("bigint").alias("event_id"), "ts_us", "date")


@query(f"""
  SELECT event_id, CASE event_id % {len(_NUMBERS) + len(_OTHER_NUMBERS)}
    {" ".join(
        f"WHEN {k} THEN CAST('{a.strip().strip('+')}' || abs(value) || '{b.strip()}' AS DOUBLE)"
        for k, (a, b, good) in enumerate(_NUMBERS) if good)}
    {" ".join(
        f"WHEN {k + len(_NUMBERS)} THEN CAST({v} AS DOUBLE)"
        for k, (_, v) in enumerate(_OTHER_NUMBERS) if v is not None)}
    END AS "open" FROM events""")
def parse_edge_numbers(spark, sf):
    """Number text in the forms that count, and in those that do not."""
    value = F.abs("value").cast("string")
    forms = [F.concat(F.lit(a), value, F.lit(b)) for a, b, _ in _NUMBERS]
    forms += [F.lit(text) for text, _ in _OTHER_NUMBERS]
    rows = _one_bar_per_event(spark, sf, F.lit("2024-01-05"), _choice(forms, "string"))
    return rows.select(F.col("symbol").cast("bigint").alias("event_id"), "open")


# --- what does not become a row ---------------------------------------------


def _all_items(spark, sf):
    """The parsed items of all four sources, stored once."""
    candles = B.candle_responses(spark, sf, rows=B.dealt_lines(spark, sf)).drop("input_file")
    quotes = _bronze(spark, sf, rows=B.dealt_events(spark, sf))
    return materialise(payloads.parsed(quotes.unionByName(candles)))


@query("""
  SELECT 'coingecko' AS source, 'crypto_simple_price-' || strftime(ts, '%Y%m%d') AS run_id,
         epoch_us(ts) AS ingest_us, 2 AS place, 'price' AS reason,
         '{"asset":"' || user_id || '","currency":"bad","price":"n/a"}' AS item FROM events
  UNION ALL
  SELECT 'coingecko_market_chart', 'crypto_market_chart-' || strftime(ts, '%Y%m%d'), epoch_us(ts), 2,
         'price', '["' || epoch_us(ts) // 1000 || '"]' FROM events
  UNION ALL
  SELECT 'frankfurter', 'forex_latest-' || strftime(ts, '%Y%m%d'), epoch_us(ts), 2, 'price',
         '{"base":"EUR","date":"' || strftime(ts, '%Y-%m-%d') || '","currency":"XXX","rate":"-"}'
  FROM events
  UNION ALL
  SELECT 'twelvedata', 'time_series-' || strftime(l_shipdate, '%Y%m%d'), epoch_us(l_shipdate),
         CASE WHEN l_returnflag = 'R' THEN 0 ELSE 1 END,
         CASE WHEN l_returnflag = 'R' THEN 'status' ELSE 'time' END,
         CASE WHEN l_returnflag <> 'R' THEN
           '{"datetime":"soon","open":"1","high":"1","low":"1","close":"1","volume":"1"}' END
  FROM lineitem""")
def parse_rejects(spark, sf):
    """Everything of four sources that did not become a row, with reason and place."""
    refused = payloads.refusals(_all_items(spark, sf))
    return refused.select(
        "source", "run_id", F.unix_micros("ingest_ts").alias("ingest_us"), "place", "reason",
        F.when(F.col("reason") != payloads.NOT_OK, F.col("item")).alias("item"),
    )


@query("""
  SELECT source, 3 * count(*) AS items, 2 * count(*) AS n_rows, count(*) AS refused
  FROM events, (VALUES ('coingecko'), ('coingecko_market_chart'), ('frankfurter')) s(source)
  GROUP BY source
  UNION ALL
  SELECT 'twelvedata', count(*) + count(*) FILTER (WHERE l_returnflag <> 'R'),
         count(*) FILTER (WHERE l_returnflag <> 'R'), count(*) FROM lineitem""")
def parse_accounts(spark, sf):
    """Items read, rows made and items refused of one stored parse: the first is the sum."""
    items = _all_items(spark, sf)
    made = payloads.price_rows(items).select("source").unionByName(
        payloads.candle_rows(items).select("source")
    ).groupBy("source").agg(F.count(F.lit(1)).alias("n_rows"))
    refused = payloads.refusals(items).groupBy("source").agg(F.count(F.lit(1)).alias("refused"))
    read = items.groupBy("source").agg(F.count(F.lit(1)).alias("items"))
    return read.join(made, "source").join(refused, "source")


@query("""
  SELECT event_id, 'k' AS "key", CAST(json_extract_string(props, '$.k') AS DOUBLE) AS amount
  FROM events WHERE json_extract_string(props, '$.k') IS NOT NULL""")
def parse_props_map(spark, sf):
    entries = F.explode(F.from_json("props", "map<string, string>")).alias("key", "text")
    rows = B.table(spark, sf, "events").select("event_id", entries)
    return rows.select("event_id", "key", number(F.col("text")).alias("amount"))


def _bronze(spark, sf, rows=None):
    sources = (B.spot_responses, B.history_responses, B.fx_responses)
    first, *rest = (make(spark, sf, rows=rows) for make in sources)
    for more in rest:
        first = first.unionByName(more)
    return first


@query(f"{_SPOT_SQL} UNION ALL {_HISTORY_SQL} UNION ALL {_FX_SQL}")
def silver_union(spark, sf):
    return _epoch(payloads.prices(_bronze(spark, sf)))


@query("""
  SELECT source, count(*) AS records
  FROM events, (VALUES ('coingecko'), ('coingecko_market_chart'), ('frankfurter')) s(source)
  GROUP BY source UNION ALL SELECT 'twelvedata', count(*) FROM lineitem""")
def source_counts(spark, sf):
    candles = B.candle_responses(spark, sf).drop("input_file")
    return payloads.source_counts(_bronze(spark, sf).unionByName(candles))


@query("""
  SELECT count(*) AS n_rows,
         count(DISTINCT CASE WHEN l_linenumber % 3 < 2 THEN CAST(l_suppkey AS VARCHAR)
                             ELSE 'BRK B' END) AS symbols
  FROM lineitem WHERE l_returnflag <> 'R'""")
def candle_totals(spark, sf):
    return payloads.candle_totals(payloads.candles(B.candle_responses(spark, sf)))


@query("""
  SELECT event_type, user_id, ts, "value" FROM (
    SELECT *, row_number() OVER (PARTITION BY event_type, user_id ORDER BY ts DESC) AS rn
    FROM events) WHERE rn = 1""")
def dedupe_newest_quote(spark, sf):
    events = B.table(spark, sf, "events").select("event_type", "user_id", "ts", "value")
    return dedupe_latest(events, ["event_type", "user_id"], newest_by=["ts"])


@query("""
  SELECT l_orderkey, l_linenumber, l_shipdate, l_suppkey, l_extendedprice FROM (
    SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
               ORDER BY l_shipdate DESC, l_suppkey DESC, l_extendedprice DESC) AS rn
    FROM lineitem) WHERE rn = 1""")
def dedupe_latest_rows(spark, sf):
    lines = B.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_shipdate", "l_suppkey", "l_extendedprice"
    )
    return dedupe_latest(lines, ["l_orderkey", "l_linenumber"], newest_by=["l_shipdate"])
