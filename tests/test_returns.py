"""Returns and volatility on small frames, and the cutting of long series."""

import math
import random
import statistics
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tickstone.operators import returns as R
from tickstone.operators.series import CHUNK, along_series, split_long_series

START = datetime(2024, 1, 1)
BAR = (
    "ts_utc timestamp_ntz, asset_type string, symbol string, interval string, "
    "currency string, close double, source string"
)


def series(closes, symbol="A", asset="stock", interval="1day", currency="USD"):
    return [
        (START + timedelta(days=i), asset, symbol, interval, currency, c, "t")
        for i, c in enumerate(closes)
    ]


def bars(spark, *parts):
    return spark.createDataFrame([row for p in parts for row in p], BAR)


def got(df, *columns):
    return [tuple(r) for r in df.orderBy("asset_type", "symbol", "ts_utc").select(*columns).collect()]


def test_returns_invert_to_prices(spark):
    closes = [10.0, 11.0, 9.9, 9.9]
    rows = got(R.returns(bars(spark, series(closes))), "close_prev", "return_1d", "close")
    assert len(rows) == 3
    for prev, ret, close in rows:
        assert math.isclose(prev * (1 + ret), close)


def test_zero_and_missing_closes_have_no_return(spark):
    df = R.returns(bars(spark, series([1.0, 0.0, 2.0, None, 3.0, 6.0])))
    assert got(df, "return_1d") == [(-1.0,), (1.0,)]


def test_series_do_not_mix(spark):
    df = R.returns(bars(
        spark, series([1.0, 2.0], "X", "stock"), series([5.0, 10.0], "X", "crypto"),
        series([7.0, 14.0], "X", "stock", currency="EUR"),
        series([3.0, 6.0], "X", "stock", interval="spot"),
        series([4.0, 8.0], "X", "stock", currency=None),
    ))
    assert df.count() == 5
    assert {r.return_1d for r in df.collect()} == {1.0}


def test_key_by_symbol_alone(spark):
    both = bars(spark, series([1.0], "X", "stock"), series([5.0], "X", "crypto")[:1])
    moved = both.withColumn(
        "ts_utc", F.when(F.col("asset_type") == "stock", F.col("ts_utc"))
        .otherwise(F.col("ts_utc") + F.expr("interval 1 day"))
    )
    df = R.returns(moved, keys=["symbol"])
    assert got(df, "return_1d") == [(4.0,)]
    assert "currency" not in df.columns


def test_symbols_keep_leading_zeros(spark):
    df = R.returns(bars(spark, series([1.0, 2.0], "005930")))
    assert got(df, "symbol") == [("005930",)]


def test_currency_preference(spark):
    schema = BAR.replace("close double", "price double")
    rows = [
        *series([1.0], "both", currency="USD"), *series([1.0], "both", currency="eur"),
        *series([1.0], "both", currency=None), *series([1.0], "euro", currency="eur"),
        *series([1.0], "none", currency=None), *series([1.0], None, currency="usd"),
        *series([1.0], None, currency="gbp"),
    ]
    kept = R.prefer_currency(spark.createDataFrame(rows, schema))
    assert {(r.symbol, r.currency) for r in kept.collect()} == {
        ("both", "USD"), ("euro", "eur"), ("none", None), (None, "usd")
    }


@pytest.mark.parametrize("n, expected", [(9, 0), (10, 0), (11, 1), (31, 21), (32, 22)])
def test_volatility_gate(spark, n, expected):
    closes = [100 + (i * 7919 % 13) for i in range(n)]
    df = R.volatility_from_bars(bars(spark, series([float(c) for c in closes])))
    assert df.count() == expected


def test_volatility_is_the_sample_deviation_of_thirty_rows(spark):
    rng = random.Random(1)
    closes = [rng.uniform(1, 9) for _ in range(60)]
    rets = [b / a - 1 for a, b in zip(closes, closes[1:])]
    rows = got(R.volatility_from_bars(bars(spark, series(closes))), "volatility")
    expected = [statistics.stdev(rets[max(0, i - 29): i + 1]) for i in range(9, 59)]
    assert [r[0] for r in rows] == pytest.approx(expected)


def test_incremental_equals_full(spark):
    rng = random.Random(2)
    parts = [
        series([rng.choice([0.0, None, rng.uniform(1, 9), rng.uniform(1, 9)]) for _ in range(90)], s)
        for s in "ABC"
    ] + [series([1.0, 2.0], "old")]
    df = bars(spark, *parts)
    day = "2024-02-20"
    full = R.returns(df)
    shown = ("symbol", "ts_utc", "return_1d")
    assert got(R.returns_since(df, day), *shown) == got(full.filter(F.col("date") >= day), *shown)
    risk = R.volatility(full).filter(F.col("date") >= day)
    shown = ("symbol", "ts_utc", "volatility")
    assert got(R.volatility_since(full, day), *shown) == got(risk, *shown)


def test_one_exchange_for_returns_and_volatility(spark):
    df = R.volatility_from_bars(bars(spark, series([1.0, 2.0])), long_series=None)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_short_series_are_left_alone(spark):
    df = bars(spark, series([1.0] * 5))
    assert split_long_series(df, ["symbol"], limit=5) is df
    assert CHUNK in split_long_series(df, ["symbol"], limit=4).columns


@pytest.mark.parametrize("lookback", [1, 4, 31])
@pytest.mark.parametrize("ascending", [True, False])
def test_chunks_see_what_the_whole_series_sees(spark, lookback, ascending):
    """Long, short and null-keyed series, chunks shorter than the lookback."""
    rng = random.Random(lookback)
    sizes = {"long": 400, "longer": 700, "short": 30, "one": 1, None: 300}
    rows = [
        (s, START + timedelta(minutes=rng.randrange(10**9)), float(i))
        for s, n in sizes.items() for i in range(n)
    ]
    df = spark.createDataFrame(rows, "symbol string, ts_utc timestamp_ntz, x double")
    order = F.col("ts_utc").asc() if ascending else F.col("ts_utc").desc()

    def windowed(part, by):
        w = Window.partitionBy(*by).orderBy(order)
        frame = w.rowsBetween(-lookback, 0)
        return part.withColumns({
            "far": F.lag("x", lookback).over(w),
            "total": F.sum("x").over(frame),
            "n": F.count("x").over(frame),
        })

    plain = windowed(df, ["symbol"])
    split = split_long_series(df, ["symbol"], limit=37)
    assert split.select("symbol", CHUNK).distinct().count() > 30
    cut = along_series(split, ["symbol"], lookback, windowed, ascending=ascending).drop(CHUNK)
    assert cut.columns == plain.columns
    assert sorted(map(str, cut.collect())) == sorted(map(str, plain.collect()))


def test_short_series_are_cut_to_a_day_in_the_windows_own_order(spark):
    rng = random.Random(7)
    parts = [
        series([rng.choice([0.0, None, rng.uniform(1, 9), rng.uniform(1, 9)]) for _ in range(90)], s)
        for s in "ABC"
    ] + [series([1.0, 2.0, 3.0], "old")]
    full, day = R.returns(bars(spark, *parts)), "2024-02-20"
    for rows in (0, 1, 29):
        asked = (R.with_lead_in(full, day, rows, long_series=limit) for limit in (None, 2_000_000))
        first, second = (got(df, "symbol", "ts_utc", "return_1d") for df in asked)
        assert first == second
    made = R.returns(bars(spark, *parts), long_series=None)
    shown = ("symbol", "ts_utc", "volatility")
    risk = R.volatility(full).filter(F.col("date") >= day)
    since = R.volatility_since(made, day, long_series=None)
    assert got(since, *shown) == got(risk, *shown)
    plan = since._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Sort [") == 1
