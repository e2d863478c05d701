"""Queries over look-ups, run bookkeeping and storage."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from ..operators import ledger as L
from ..operators import returns as R
from ..operators import serving as V
from ..sources.files import storage_inventory as inventory
from . import bindings as B
from .gold import CURRENCY_QUOTES, QUOTE_RETURNS, RETURN_COLUMNS, RETURN_NUMBERS, quote_bars
from .registry import query

_SHOWN = f"{RETURN_COLUMNS}, {RETURN_NUMBERS}"


def _returns(spark, sf):
    return R.returns(quote_bars(spark, sf))


@query(f"""{QUOTE_RETURNS} SELECT {_SHOWN} FROM r WHERE asset_type = 'event' AND symbol = '7'
ORDER BY ts_utc DESC LIMIT 100""")
def latest_series(spark, sf):
    return V.latest_series(_returns(spark, sf), "event", "7")


@query(f"""{QUOTE_RETURNS} SELECT * FROM (
  SELECT {_SHOWN} FROM r WHERE asset_type = 'event' AND symbol = '7'
  ORDER BY ts_utc DESC LIMIT 30) ORDER BY ts_utc""")
def chart_series(spark, sf):
    return V.chart_series(_returns(spark, sf), "event", "7", 30)


@query(f"""
WITH {CURRENCY_QUOTES}, {B.returns_sql('q', 'price', B.SERIES)}
SELECT {_SHOWN} FROM (
  SELECT *, row_number() OVER (PARTITION BY {B.SERIES} ORDER BY ts_utc DESC) AS rn FROM r
  WHERE asset_type = 'view' AND symbol = '7')
WHERE rn <= 3""")
def latest_currencies(spark, sf):
    """A page of each series of a symbol quoted in three currencies."""
    quotes = B.quotes(spark, sf, F.col("event_type"), currency=B.three_currencies())
    return V.latest_series(R.returns(R.bars_from_quotes(quotes)), "view", "7", 3)


@query(f"""{QUOTE_RETURNS} SELECT {_SHOWN} FROM (
  SELECT *, row_number() OVER (PARTITION BY {B.SERIES} ORDER BY ts_utc DESC) AS rn FROM r)
WHERE rn <= 30""")
def series_topk(spark, sf):
    return V.series_topk(_returns(spark, sf), 30)


@query("""
SELECT ts AS ts_utc, 'event' AS asset_type, 'all' AS symbol, event_id, "value" FROM events
ORDER BY ts DESC, event_id LIMIT 5000""")
def series_topk_deep(spark, sf):
    """More rows than Spark cuts before an exchange, from one series of all events."""
    events = B.table(spark, sf, "events").select(
        F.col("ts").alias("ts_utc"), F.lit("event").alias("asset_type"), F.lit("all").alias("symbol"),
        "event_id", "value",
    )
    return V.series_topk(events, 5000, long_series=6000)


@query(f"{QUOTE_RETURNS} SELECT DISTINCT asset_type, symbol FROM r ORDER BY ALL")
def symbols(spark, sf):
    return V.symbols(_returns(spark, sf))


# --- runs: a data set per event type, a run per day ------------------------

_RUNS_SQL = """
m AS (SELECT event_type || '-' || strftime(ts, '%Y%m%d') AS run_id, 'events' AS source,
             event_type AS dataset, strftime(ts, '%Y-%m-%d') AS ingest_ts,
             strftime(ts, '%Y-%m-%d') AS "date", CAST(sum(1) AS BIGINT) AS record_count,
             'success' AS status
      FROM events WHERE {which} GROUP BY ALL)"""


def _records(spark, sf, least=None):
    ev = B.table(spark, sf, "events")
    ev = ev if least is None else ev.filter(F.col("value") > least)
    day = F.date_format("ts", "yyyy-MM-dd")
    return ev.select(
        F.concat_ws("-", "event_type", F.date_format("ts", "yyyyMMdd")).alias("run_id"),
        F.lit("events").alias("source"),
        F.col("event_type").alias("dataset"),
        day.alias("ingest_ts"),
        day.alias("date"),
    )


@query(f"WITH {_RUNS_SQL.format(which='true')} SELECT * FROM m")
def run_manifest(spark, sf):
    return L.run_manifest(_records(spark, sf))


@query("""
WITH m AS (
  SELECT strftime(ts, '%Y%m%d') AS run, strftime(ts, '%Y-%m-%d') AS "date",
         strftime(min(ts), '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS ingest_ts, count(*) AS n,
         list_sort(list(DISTINCT CAST(user_id AS VARCHAR))) AS coins
  FROM events GROUP BY ALL)
SELECT 'crypto_market_chart-' || run AS run_id, 'coingecko_market_chart' AS source,
       'crypto_market_chart' AS dataset, ingest_ts, "date",
       '{"coin":' || CASE WHEN len(coins) = 1 THEN '"' || coins[1] || '"'
         ELSE '["' || array_to_string(coins, '","') || '"]' END || ',"vs_currency":"usd"}' AS request_params,
       CAST(3 * n AS BIGINT) AS record_count, 'success' AS status FROM m""")
def history_manifest(spark, sf):
    """Runs that count the points their responses carry, and say what was asked for."""
    records = B.history_responses(spark, sf)
    return L.run_manifest(records, size=L.history_points(), params=L.request_params(records))


@query(f"""
WITH {_RUNS_SQL.format(which='"value" > 350')},
planned AS (SELECT DISTINCT event_type AS dataset, strftime(ts, '%Y-%m-%d') AS "date" FROM events)
SELECT * FROM planned p WHERE NOT EXISTS (
  SELECT 1 FROM m WHERE m.dataset = p.dataset AND m."date" = p."date")""")
def ledger_pending(spark, sf):
    done = L.run_manifest(_records(spark, sf, 350))
    planned = _records(spark, sf).select("dataset", "date").distinct()
    return L.ledger_pending(planned, done, ["dataset", "date"])


@query(f"""
WITH {_RUNS_SQL.format(which='"value" > 350')}
SELECT strftime(d, '%Y-%m-%d') AS "date", 'view' AS dataset
FROM generate_series(TIMESTAMP '2023-12-25', TIMESTAMP '2024-02-05', INTERVAL 1 DAY) g(d)
WHERE strftime(d, '%Y-%m-%d') NOT IN (SELECT "date" FROM m WHERE dataset = 'view')""")
def backfill_days(spark, sf):
    done = L.run_manifest(_records(spark, sf, 350))
    return L.backfill_days(spark, "2023-12-25", "2024-02-05", done, "view")


@query("""
SELECT 'time_series-' || strftime(l_shipdate, '%Y%m%d') AS run_id, count(*) AS responses
FROM lineitem WHERE l_returnflag <> 'R' GROUP BY ALL""")
def successful_responses(spark, sf):
    good = L.successful_responses(B.candle_responses(spark, sf))
    return good.groupBy("run_id").agg(F.count(F.lit(1)).alias("responses"))


@query("""
SELECT 'events' AS name, count(*) AS n_rows FROM events UNION ALL
SELECT 'lineitem', count(*) FROM lineitem UNION ALL SELECT 'orders', count(*) FROM orders""")
def storage_inventory(spark, sf):
    """Rows by stored table (files and bytes depend on how it was written)."""
    def listed(name):
        return inventory(B.table(spark, sf, name)).agg(
            F.lit(name).alias("name"), F.sum("rows").alias("n_rows")
        )

    return reduce(lambda a, b: a.unionByName(b), map(listed, ("events", "lineitem", "orders")))
