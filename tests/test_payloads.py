"""Bronze files in every folder layout, through the parsers."""

import gzip
import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tickstone.functions import wall_clock_utc
from tickstone.operators import payloads
from tickstone.sources import files

SPOT = {
    "source": "coingecko", "dataset": "crypto_simple_price", "run_id": "r1",
    "ingest_ts": "2026-02-27T05:00:00.123456+00:00", "ids": ["bitcoin"],
    "vs_currencies": ["usd", "eur"],
    "data": {
        "bitcoin": {"usd": 60000, "eur": 55000.5, "gbp": "n/a"},
        "ethereum": {"usd": None}, "nothing": None, "": {"usd": 1},
    },
}
HISTORY = {
    "source": "coingecko_market_chart", "dataset": "crypto_market_chart", "run_id": "r2",
    "ingest_ts": "2026-02-27T05:30:00+00:00", "coin": "bitcoin", "vs_currency": "usd",
    "params": {"days": "90", "from_ts": None},
    "data": {"prices": [[1700000000123, 37000.5], [1700086400000, 38000], [1700172800000], []]},
}
FX = {
    "source": "frankfurter", "dataset": "forex_latest", "run_id": "r3",
    "ingest_ts": "2026-02-27T06:00:00+00:00", "request": {"base": "EUR", "symbols": ["USD"]},
    "data": {"base": "EUR", "date": "2026-02-26", "rates": {"USD": 1.1, "GBP": 0.85}},
}


def candle(symbol=None, asked=None, status="ok", values=None, interval="1day"):
    values = values if values is not None else [
        {"datetime": "2026-02-26", "open": "1.5", "high": "2", "low": "1", "close": "1.75",
         "volume": ""},
        {"datetime": "2026-02-27 15:30:00", "open": "x", "high": "2", "low": "1", "close": "2",
         "volume": "10"},
        {"datetime": "junk", "open": "1", "high": "1", "low": "1", "close": "1"},
    ]
    return {
        "source": "twelvedata", "dataset": "time_series", "run_id": "r4",
        "ingest_ts": "2026-02-27T05:30:00+00:00",
        "request": {"symbol": asked, "interval": interval, "outputsize": "30"},
        "data": {"status": status, "meta": {"symbol": symbol, "currency": "USD"}, "values": values},
    }


def land(root, folder, *records, raw=()):
    path = root / folder
    path.mkdir(parents=True)
    lines = [json.dumps(r) for r in records] + list(raw)
    (path / "data.jsonl.gz").write_bytes(gzip.compress("\n".join(lines).encode()))


@pytest.fixture
def bronze(tmp_path):
    day = "date=2026-02-27"
    land(tmp_path, f"coingecko/crypto_simple_price/{day}/run_id=r1", SPOT)
    land(tmp_path, f"coingecko/crypto_market_chart/{day}/coin=bitcoin/run_id=r2", HISTORY)
    land(tmp_path, "frankfurter/forex_latest/date=2026-02-26/run_id=r3", FX, raw=["{broken"])
    base = f"twelvedata/time_series/{day}"
    land(tmp_path, f"{base}/symbol=A/run_id=r4", candle("005930", "other"), candle("", "AAPL"))
    land(tmp_path, f"{base}/symbol=BRK B/run_id=r5", candle(), candle("E", status="error"))
    land(tmp_path, f"{base}/run_id=r6", candle(interval=None))
    (tmp_path / base / "run_id=r6" / "manifest.json").write_text('{"status": "success"}')
    return str(tmp_path)


def test_every_layout_is_read(spark, bronze):
    df = files.read_bronze(spark, bronze)
    assert {r.source for r in df.filter("source is not null").collect()} == {
        "coingecko", "coingecko_market_chart", "frankfurter", "twelvedata"
    }
    assert [r._corrupt_record for r in payloads.rejects(df).collect()] == ["{broken"]


def test_one_day_and_one_source(spark, bronze):
    day = files.read_bronze(spark, bronze, date="2026-02-26")
    assert [r.source for r in day.filter("source is not null").collect()] == ["frankfurter"]
    assert files.read_bronze(spark, bronze, date="1999-01-01").isEmpty()
    assert files.read_bronze(spark, bronze, source="coingecko").count() == 1


def test_missing_root_is_empty(spark, tmp_path):
    assert files.read_bronze(spark, str(tmp_path / "none")).isEmpty()


def test_spot(spark, bronze):
    rows = payloads.parse_spot_map(files.read_bronze(spark, bronze)).collect()
    assert {(r.symbol, r.currency, r.price) for r in rows} == {
        ("bitcoin", "usd", 60000.0), ("bitcoin", "eur", 55000.5), ("", "usd", 1.0)
    }
    assert {(r.asset_type, r.interval, r.date) for r in rows} == {("crypto", "spot", "2026-02-27")}
    assert all(r.ts_utc == r.ingest_ts for r in rows)


def test_history(spark, bronze):
    df = payloads.parse_history_pairs(files.read_bronze(spark, bronze))
    rows = df.withColumn("ms", F.unix_millis("ts_utc")).orderBy("ms").collect()
    assert [(r.ms, r.price, r.interval) for r in rows] == [
        (1700000000123, 37000.5, "1d"), (1700086400000, 38000.0, "1d")
    ]


def test_fx(spark, bronze):
    df = payloads.parse_fx_rates(files.read_bronze(spark, bronze))
    rows = df.withColumn("at", wall_clock_utc(F.col("ts_utc"))).orderBy("symbol").collect()
    assert [(r.symbol, r.currency, r.price) for r in rows] == [
        ("EURGBP", "GBP", 0.85), ("EURUSD", "USD", 1.1)
    ]
    assert {r["at"] for r in rows} == {datetime(2026, 2, 26)}


def test_candles(spark, bronze):
    df = payloads.candles(files.read_bronze(spark, bronze))
    rows = df.orderBy("symbol", "ts_utc").collect()
    assert [r.symbol for r in rows] == [
        s for s in ("005930", "AAPL", "BRK B", "UNKNOWN") for _ in range(2)
    ]
    assert {r.interval for r in rows} == {"1day"}
    first, second = rows[0], rows[1]
    assert (first.open, first.close, first.volume, first.date) == (1.5, 1.75, None, "2026-02-26")
    assert (second.open, second.close, second.volume, second.date) == (None, 2.0, 10.0, "2026-02-27")


def test_results_do_not_depend_on_session_zone(spark, bronze):
    def snapshot():
        landed = files.read_bronze(spark, bronze)
        both = payloads.prices(landed).select(F.unix_micros("ts_utc"), "date", "symbol").union(
            payloads.candles(landed).select(F.unix_micros("ts_utc"), "date", "symbol")
        )
        return sorted(map(tuple, both.collect()))

    utc = snapshot()
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert snapshot() == utc
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_rows_of_one_row_group_are_parsed_by_many_tasks(spark, tmp_path):
    from pyspark.sql import functions as F

    from tickstone.workload import bindings as B

    made = spark.range(2000).select(
        F.timestamp_seconds(F.col("id") % 900).cast("timestamp_ntz").alias("ts"), (F.col("id") % 50).alias("user_id"),
        (F.col("id") % 7).cast("double").alias("value"), F.col("id").alias("event_id"),
    )
    made.coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    rows = B.dealt_events(spark, str(tmp_path))
    used = rows.groupBy(F.spark_partition_id()).count().count()
    assert used >= spark.sparkContext.defaultParallelism
    for make in (B.spot_responses, B.history_responses, B.fx_responses):
        plain, dealt = make(spark, str(tmp_path)), make(spark, str(tmp_path), rows=rows)
        assert plain.exceptAll(dealt).isEmpty() and dealt.count() == 2000
