"""Writing, merging and reading stored tables, runs and look-ups."""

import json
from datetime import datetime

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tickstone import schemas as S
from tickstone.operators import ledger as L
from tickstone.operators import serving as V
from tickstone.operators.latest import dedupe_latest
from tickstone.plans import jobs
from tickstone.sinks import layout, tables
from tickstone.sources import files

T0 = datetime(2024, 1, 1)


def prices(spark, *specs):
    rows = [
        (T0, "2024-01-01" if d is None else d, "crypto", sym, "spot", "usd", p, src, "r",
         datetime(2024, 1, 2, hour))
        for sym, p, src, hour, d in specs
    ]
    return spark.createDataFrame(rows, S.PRICES)


def stored(spark, path):
    df = files.read_table(spark, path, S.PRICES)
    return {(r.symbol, r.price, r.source, r.date) for r in df.collect()}


def test_upsert_keeps_other_sources_and_takes_the_newest(spark, tmp_path):
    path = str(tmp_path / "prices")
    def put(*specs):
        return tables.upsert(prices(spark, *specs), path, S.PRICES, jobs.PRICE_ROW)

    put(("A", 1.0, "one", 1, None), ("A", 2.0, "one", 3, None), ("Z", 9.0, "one", 1, None))
    put(("A", 5.0, "two", 1, None))
    assert stored(spark, path) == {
        ("A", 2.0, "one", "2024-01-01"), ("A", 5.0, "two", "2024-01-01"),
        ("Z", 9.0, "one", "2024-01-01"),
    }
    put(("A", 7.0, "one", 2, None))  # older than what is stored
    put(("A", 8.0, "two", 4, None))
    assert ("A", 2.0, "one", "2024-01-01") in stored(spark, path)
    assert ("A", 8.0, "two", "2024-01-01") in stored(spark, path)
    assert put() == 0


def test_partition_values_survive(spark, tmp_path):
    path = str(tmp_path / "prices")
    odd = prices(spark, ("005930", 1.0, "s", 1, None), ("BRK B", 1.0, "s", 1, None),
                 ("EUR/USD", 1.0, "s", 1, None), ("", 1.0, "s", 1, None), (None, 1.0, "s", 1, None))
    assert tables.write_partitioned(odd, path) == 5
    assert sorted(r[0] for r in stored(spark, path)) == [
        "005930", "BRK B", "EUR/USD", "UNKNOWN"
    ] and files.read_table(spark, path, S.PRICES).count() == 5


def test_write_replaces_only_its_partitions(spark, tmp_path):
    path = str(tmp_path / "prices")
    tables.write_partitioned(
        prices(spark, ("A", 1.0, "s", 1, None), ("A", 2.0, "s", 1, "2024-01-02")), path
    )
    current = files.read_table(spark, path, S.PRICES).filter(F.col("date") == "2024-01-02")
    tables.write_partitioned(current.withColumn("price", F.col("price") + 1), path)
    assert stored(spark, path) == {("A", 1.0, "s", "2024-01-01"), ("A", 3.0, "s", "2024-01-02")}


def test_huge_folders_are_split_and_small_ones_are_not(spark):
    df = spark.range(1000).select(
        F.col("id"), F.when(F.col("id") < 900, "big").otherwise(F.col("id").cast("string")).alias("f")
    )
    laid = layout.by_folder(df, ["f"], rows_per_file=100)
    tasks = laid.withColumn("t", F.spark_partition_id()).groupBy("f").agg(
        F.count_distinct("t").alias("tasks"), F.count("id").alias("n")
    )
    found = {r.f: (r.tasks, r.n) for r in tasks.collect()}
    assert found.pop("big")[0] > 3 and set(found.values()) == {(1, 1)}
    assert laid.count() == 1000 and laid.columns == df.columns


def test_day_filter_prunes_folders(spark, tmp_path):
    path = str(tmp_path / "prices")
    tables.write_partitioned(prices(spark, ("A", 1.0, "s", 1, None)), path)
    plan = files.read_table(spark, path, S.PRICES, "2024-01-01")._jdf.queryExecution()
    text = plan.executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in text


def test_only_a_missing_path_counts_as_no_table(spark, tmp_path):
    assert files.read_table(spark, str(tmp_path / "none"), S.PRICES) is None
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "x.parquet").write_text("not parquet")
    with pytest.raises(Exception):
        files.read_table(spark, str(tmp_path / "bad"), S.PRICES).collect()
    with pytest.raises(AnalysisException):
        files._or_none(lambda: spark.table("no_such_table"))


def test_history_table_over_batches(spark, tmp_path):
    path = str(tmp_path / "history")

    def put(*specs, **more):
        return tables.apply_versions(
            prices(spark, *specs), path, S.PRICE_HISTORY, S.PRICE_VERSION_KEYS, ["price"], **more
        )

    assert put(("A", 1.0, "s", 1, None), ("B", 1.0, "s", 1, None)) == {"opened": 2, "closed": 0}
    assert put(("A", 2.0, "s", 5, "2024-01-02")) == {"opened": 1, "closed": 1}
    assert put(("A", 2.0, "s", 5, "2024-01-02")) == {"opened": 0, "closed": 0}
    assert put(("A", 3.0, "s", 2, "2024-01-03")) == {"opened": 0, "closed": 0}
    rows = files.read_table(spark, path, S.PRICE_HISTORY).collect()
    assert {(r.symbol, r.price, r.date, r.is_current, r.valid_to) for r in rows} == {
        ("A", 1.0, "2024-01-01", False, datetime(2024, 1, 2, 5)),
        ("A", 2.0, "2024-01-02", True, None),
        ("B", 1.0, "2024-01-01", True, None),
    }


def test_predictions_round_trip(spark, tmp_path):
    path = str(tmp_path / "predictions")
    assert files.read_predictions(spark, path).isEmpty()
    row = spark.createDataFrame([("crypto", "A", 0.5, "buy")], "asset_type string, symbol string, "
                                "prediction_return double, action string")
    tables.write_predictions(row, path)
    back = files.read_predictions(spark, path).first()
    assert (back.symbol, back.prediction_return, back.generated_at[-6:]) == ("A", 0.5, "+00:00")
    document = tmp_path / "latest.json"
    document.write_text(json.dumps({"generated_at": "now", "predictions": [
        {"asset_type": "crypto", "symbol": "A", "samples": 20},
        {"asset_type": "stock", "symbol": "B", "samples": 30}]}))
    one = V.predictions_lookup(files.read_predictions_document(spark, str(document)), "stock")
    assert [(r.generated_at, r.symbol, r.samples) for r in one.collect()] == [("now", "B", 30)]


def test_look_ups(spark):
    df = prices(spark, ("A", 1.0, "s", 1, None), ("B", 2.0, "s", 1, None))
    assert [tuple(r) for r in V.symbols(df).collect()] == [("crypto", "A"), ("crypto", "B")]
    assert V.symbols(df, "stock").isEmpty()
    assert V.latest_series(df, "crypto", "A").first().price == 1.0
    with pytest.raises(ValueError):
        V.latest_series(df, "crypto", "A", 1001)
    assert V.predictions_lookup(df).count() == 2
    assert V.predictions_lookup(df, symbol="B").first().price == 2.0


def test_page_is_a_top_k(spark):
    df = spark.range(10**5).selectExpr("'a' asset_type", "'b' symbol", "id ts_utc")
    plan = V.latest_series(df, "a", "b")._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_dedupe_cuts_copies_before_the_exchange(spark):
    df = spark.range(1000).selectExpr("id % 3 k", "id ingest_ts", "'x' v")
    kept = dedupe_latest(df, ["k"])
    assert sorted(r.ingest_ts for r in kept.collect()) == [997, 998, 999]
    assert "WindowGroupLimit" in kept._jdf.queryExecution().executedPlan().toString()


def test_dedupe_settles_ties_by_the_rest_of_the_row(spark):
    rows = [(1, 5, "a"), (1, 5, "b"), (None, 1, "c"), (None, 2, "d")]
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, "k int, ingest_ts int, v string")
        assert {r.v for r in dedupe_latest(df, ["k"]).collect()} == {"b", "d"}


def test_pending_units(spark):
    ledger = spark.createDataFrame(
        [("d", "2024-01-02", None, "success"), ("d", "2024-01-03", None, "failed")],
        "dataset string, date string, unit string, status string",
    )
    days = L.backfill_days(spark, "2024-01-01", "2024-01-03", ledger, "d")
    assert sorted(r.date for r in days.collect()) == ["2024-01-01", "2024-01-03"]
    planned = spark.createDataFrame(
        [("d", "2024-01-02", None), ("d", "2024-01-02", "x")],
        "dataset string, date string, unit string",
    )
    left = L.ledger_pending(planned, ledger, ["dataset", "date", "unit"])
    assert [r.unit for r in left.collect()] == ["x"]


def test_error_responses_are_skipped(spark):
    df = spark.createDataFrame([('{"status": "error"}',), ('{"status": "ok"}',), ("{}",)], "data string")
    assert L.successful_responses(df).count() == 2


def test_gold_jobs_without_input(spark, tmp_path):
    silver, gold = str(tmp_path / "s"), str(tmp_path / "g")
    assert jobs.silver_to_gold(spark, silver, gold) == {"returns_daily": 0, "volatility_30d": 0}
    assert jobs.predict(spark, gold) is None


def test_whole_tables_lose_partitions_no_longer_filled(spark, tmp_path):
    path = str(tmp_path / "t")
    df = prices(spark, ("A", 1.0, "s", 1, None), ("B", 2.0, "s", 1, None))
    assert tables.write_partitioned(df, path) == 2

    def stored():
        return sorted(r.symbol for r in spark.read.schema(S.PRICES).parquet(path).collect())

    tables.write_partitioned(df.filter("symbol = 'A'"), path)
    assert stored() == ["A", "B"]
    tables.write_partitioned(df.filter("symbol = 'A'"), path, whole=True)
    assert stored() == ["A"]
    assert tables.write_partitioned(df.limit(0), path, whole=True) == 0
    assert stored() == []


def test_series_of_a_symbol_stay_apart(spark):
    df = spark.createDataFrame(
        [("a", "b", "1d", c, t, float(t if c == "usd" else -t)) for c in ("usd", "eur") for t in range(40)],
        "asset_type string, symbol string, interval string, currency string, ts_utc int, close double",
    )
    page = [(r.currency, r.ts_utc) for r in V.latest_series(df, "a", "b", 2).collect()]
    assert page == [("eur", 39), ("eur", 38), ("usd", 39), ("usd", 38)]
    one = V.chart_series(df, "a", "b", 2, currency="usd").collect()
    assert [(r.currency, r.ts_utc) for r in one] == [("usd", 38), ("usd", 39)]
    found = {r.currency: r.action for r in V.recommendation(df, "a", "b").collect()}
    assert found["usd"] == "buy" and len(found) == 2
    assert [r.currency for r in V.recommendation(df, "a", "b", currency="eur").collect()] == ["eur"]
    for look_up in (V.latest_series, V.chart_series, V.recommendation):
        with pytest.raises(ValueError):
            look_up(df, "a", None)
