"""The shared test tables seen as quotes, candles, responses and runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# --- quotes: one per event -------------------------------------------------


def quotes(
    spark: SparkSession,
    sf: str,
    asset_type: Column | None = None,
    symbol: str = "user_id",
    currency: Column | None = None,
) -> DataFrame:
    """Events as spot quotes.  By default a series is one user's events."""
    ev = table(spark, sf, "events")
    return ev.select(
        F.col("ts").alias("ts_utc"),
        (F.lit("event") if asset_type is None else asset_type).alias("asset_type"),
        F.col(symbol).cast("string").alias("symbol"),
        F.lit(S.INTERVAL_SPOT).alias("interval"),
        (F.lit("usd") if currency is None else currency).alias("currency"),
        F.col("value").alias("price"),
        F.lit("events").alias("source"),
    )


def three_currencies() -> Column:
    return F.element_at(
        F.array(F.lit("USD"), F.lit("eur"), F.lit("gbp")), (F.col("event_id") % 3 + 1).cast("int")
    )


QUOTES_SQL = """
q AS (SELECT ts AS ts_utc, 'event' AS asset_type, CAST(user_id AS VARCHAR) AS symbol,
             'spot' AS "interval", 'usd' AS currency, "value" AS price, 'events' AS source
      FROM events)"""


# --- candles: lineitems of a supplier's day --------------------------------


def candles(spark: SparkSession, sf: str) -> DataFrame:
    """Daily bars per supplier from unit prices.

    One bar per calendar day, so a series has at most as many bars as the ship
    dates span days: callers may skip the check for long series.
    """
    px = F.col("l_extendedprice") / F.col("l_quantity")
    first_to_last = F.struct("l_orderkey", "l_linenumber", "l_partkey", "px")
    return (
        table(spark, sf, "lineitem")
        .withColumn("px", px)
        .groupBy("l_suppkey", "l_shipdate")
        .agg(
            F.min_by("px", first_to_last).alias("open"),
            F.max("px").alias("high"),
            F.min("px").alias("low"),
            F.max_by("px", first_to_last).alias("close"),
            F.sum("l_quantity").alias("volume"),
        )
        .select(
            F.col("l_shipdate").alias("ts_utc"),
            F.lit(S.ASSET_STOCK).alias("asset_type"),
            F.col("l_suppkey").cast("string").alias("symbol"),
            F.lit(S.INTERVAL_CANDLE_DAY).alias("interval"),
            "open", "high", "low", "close", "volume",
            F.lit("USD").alias("currency"),
            F.lit("lineitem").alias("source"),
        )
    )


CANDLES_SQL = """
px AS (SELECT l_suppkey, l_shipdate, l_orderkey, l_linenumber, l_partkey, l_quantity,
              l_extendedprice / l_quantity AS px FROM lineitem),
c AS (SELECT l_shipdate AS ts_utc, 'stock' AS asset_type, CAST(l_suppkey AS VARCHAR) AS symbol,
             '1day' AS "interval",
             first(px ORDER BY l_orderkey, l_linenumber, l_partkey, px) AS "open",
             max(px) AS high, min(px) AS low,
             last(px ORDER BY l_orderkey, l_linenumber, l_partkey, px) AS "close",
             sum(l_quantity) AS volume, 'USD' AS currency, 'lineitem' AS source
      FROM px GROUP BY l_suppkey, l_shipdate)"""


def returns_sql(source: str, price: str, series: str) -> str:
    """CTE ``r``: the returns of CTE ``source``; ``series`` is its key."""
    return f"""
p AS (SELECT *, {price} AS px_now,
             lag({price}) OVER (PARTITION BY {series} ORDER BY ts_utc) AS close_prev
      FROM {source}),
r AS (SELECT ts_utc, strftime(ts_utc, '%Y-%m-%d') AS "date", asset_type, symbol, "interval",
             currency, source, px_now AS "close", close_prev,
             px_now / nullif(close_prev, 0) - 1 AS return_1d
      FROM p WHERE px_now IS NOT NULL AND nullif(close_prev, 0) IS NOT NULL)"""


def volatility_sql(series: str, rows: int = 30, least: int = 10) -> str:
    """CTE ``v``: rolling volatility of CTE ``r``."""
    return f"""
v AS (SELECT * FROM (
        SELECT *, stddev_samp(return_1d) OVER w AS volatility, count(return_1d) OVER w AS n_obs
        FROM r WINDOW w AS (PARTITION BY {series} ORDER BY ts_utc
                            ROWS BETWEEN {rows - 1} PRECEDING AND CURRENT ROW))
      WHERE n_obs >= {least} AND volatility IS NOT NULL)"""


SERIES = 'asset_type, symbol, "interval", currency'


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    """Computed columns rounded, so that two engines' last bits do not matter."""
    return df.withColumns({c: F.round(c, digits) for c in columns})


# --- bronze: the same rows as JSON responses -------------------------------


def iso(column: str) -> Column:
    """A zone-free time column as ISO text in UTC."""
    return F.date_format(column, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")


def responses(df: DataFrame, source: str, dataset: str, data: Column, **more: Column):
    """Bronze records; columns a source does not send are null."""
    sent = {
        "source": F.lit(source),
        "dataset": F.lit(dataset),
        "run_id": F.concat(F.lit(f"{dataset}-"), F.date_format("ts", "yyyyMMdd")),
        "ingest_ts": iso("ts"),
        "coin": F.lit(None).cast("string"),
        "vs_currency": F.lit(None).cast("string"),
        "request": F.lit(None).cast(S.BRONZE["request"].dataType),
        **more,
        "data": data,
        "date": F.date_format("ts", "yyyy-MM-dd"),
    }
    return df.select(*(c.alias(name) for name, c in sent.items()))


def dealt(df: DataFrame) -> DataFrame:
    """Rows dealt out evenly, by their values, however few row groups their file has: making
    and parsing JSON costs many times what it costs to move the narrow rows it is made of."""
    spark = df.sparkSession
    tasks = max(2 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return df.repartition(tasks, *df.columns)


def dealt_events(spark: SparkSession, sf: str) -> DataFrame:
    """What the quote responses are made of."""
    return dealt(table(spark, sf, "events").select("ts", "user_id", "value"))


def dealt_lines(spark: SparkSession, sf: str) -> DataFrame:
    """What the candle responses are made of."""
    return dealt(table(spark, sf, "lineitem").select(
        "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag", "l_linestatus", "l_shipdate"
    ))


# Each takes the rows its responses are made of; by default those of the table.


def spot_responses(
    spark: SparkSession, sf: str, asset: str = "user_id", rows: DataFrame | None = None
) -> DataFrame:
    """``{asset: {usd: value, eur: 2 * value, bad: "n/a"}}`` per event."""
    one = F.struct(
        F.col("value").cast("string").alias("usd"),
        (F.col("value") * 2).cast("string").alias("eur"),
        F.lit("n/a").alias("bad"),
    )
    data = F.to_json(F.create_map(F.col(asset).cast("string"), one))
    rows = table(spark, sf, "events") if rows is None else rows
    return responses(rows, S.SOURCE_SPOT, "crypto_simple_price", data)


def history_responses(
    spark: SparkSession, sf: str, coin: str = "user_id", rows: DataFrame | None = None
) -> DataFrame:
    """Two points a day apart and one broken pair per event."""
    ms = F.unix_millis(F.to_timestamp(iso("ts")))
    data = F.to_json(
        F.struct(
            F.array(
                F.array(ms.cast("string"), F.col("value").cast("string")),
                F.array((ms + 86400000).cast("string"), (F.col("value") * 2).cast("string")),
                F.array(ms.cast("string")),
            ).alias("prices")
        )
    )
    rows = table(spark, sf, "events") if rows is None else rows
    return responses(
        rows, S.SOURCE_HISTORY, "crypto_market_chart", data,
        coin=F.col(coin).cast("string"), vs_currency=F.lit("usd"),
    )


def fx_responses(spark: SparkSession, sf: str, rows: DataFrame | None = None) -> DataFrame:
    """Two rates and one that is no number per event."""
    data = F.to_json(
        F.struct(
            F.lit("EUR").alias("base"),
            F.date_format("ts", "yyyy-MM-dd").alias("date"),
            F.create_map(
                F.lit("USD"), F.col("value").cast("string"),
                F.lit("GBP"), (F.col("value") * 2).cast("string"),
                F.lit("XXX"), F.lit("-"),
            ).alias("rates"),
        )
    )
    rows = table(spark, sf, "events") if rows is None else rows
    return responses(rows, S.SOURCE_FX, "forex_latest", data)


def candle_responses(spark: SparkSession, sf: str, rows: DataFrame | None = None) -> DataFrame:
    """One response per lineitem: the symbol in the payload, the request or
    only in the file's folder by line number; failed where returned."""
    li = (table(spark, sf, "lineitem") if rows is None else rows).withColumn("ts", F.col("l_shipdate"))
    line = F.col("l_linenumber") % 3
    supplier = F.col("l_suppkey").cast("string")
    bar = F.struct(
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("datetime"),
        F.col("l_extendedprice").cast("string").alias("open"),
        (F.col("l_extendedprice") * 2).cast("string").alias("high"),
        F.lit("none").alias("low"),
        F.col("l_extendedprice").cast("string").alias("close"),
        F.when(F.col("l_linestatus") == "O", F.col("l_quantity").cast("string"))
        .otherwise("").alias("volume"),
    )
    undated = F.struct(
        F.lit("soon").alias("datetime"), *(F.lit("1").alias(c) for c in ("open", "high")),
        *(F.lit("1").alias(c) for c in ("low", "close", "volume")),
    )
    data = F.to_json(
        F.struct(
            F.when(F.col("l_returnflag") == "R", "error").otherwise("ok").alias("status"),
            F.struct(
                F.when(line == 0, supplier).alias("symbol"), F.lit("USD").alias("currency")
            ).alias("meta"),
            F.array(bar, undated).alias("values"),
        )
    )
    request = F.struct(
        F.when(line == 1, supplier).alias("symbol"),
        F.lit(None).cast("string").alias("interval"),
        F.lit("30").alias("outputsize"),
        F.lit(None).cast("string").alias("base"),
    )
    made = responses(li, S.SOURCE_CANDLES, "time_series", data, request=request)
    return made.withColumn("input_file", F.lit("file:/bronze/date=d/symbol=BRK%20B/run_id=r/x.gz"))
