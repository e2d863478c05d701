"""Writes, bounded reads, spliced histories, file sizes and deep pages."""

import json
import os
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tickstone import schemas as S
from tickstone.functions.scratch import Workspace
from tickstone.operators import ledger as L
from tickstone.operators import returns as R
from tickstone.operators.series import newest_per_key
from tickstone.plans import jobs
from tickstone.sinks import layout, tables
from tickstone.sinks.landing import land_bronze
from tickstone.sources import files

DAY = datetime(2024, 1, 1)


def quotes(spark, *specs):
    """(symbol, day, price, minute of ingestion)"""
    rows = [
        (DAY + timedelta(days=d), str((DAY + timedelta(days=d)).date()), "crypto", s, "1d", "usd", float(p),
         "src", "r", DAY + timedelta(days=400, minutes=m))
        for s, d, p, m in specs
    ]
    return spark.createDataFrame(rows, S.PRICES)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def scratch(tmp_path, monkeypatch):
    """A scratch folder of its own, to see what is left in it."""
    monkeypatch.setattr("tickstone.functions.scratch.scratch_root", lambda _: str(tmp_path / "scratch"))
    return tmp_path / "scratch"


def watch_copies(monkeypatch, stored):
    """Note every copy that a write keeps apart, with its rows."""
    plain = Workspace.store
    monkeypatch.setattr(
        Workspace, "store", lambda self, df: stored.append(plain(self, df)) or stored[-1]
    )


def left_in(folder):
    return sorted(os.listdir(folder)) if folder.exists() else []


def test_rows_of_a_new_table_are_written_once(spark, scratch, tmp_path, monkeypatch):
    stored = []
    watch_copies(monkeypatch, stored)
    path = str(tmp_path / "t")
    df = quotes(spark, *((f"S{k % 3}", k % 5, k, k) for k in range(60)))
    assert tables.upsert(df, path, S.PRICES, jobs.PRICE_ROW) == 15
    assert tables.write_partitioned(df, str(tmp_path / "u"), from_itself=False) == 60
    assert stored == [] and left_in(scratch) == []
    # Merged into what is there, a row is kept apart once, and the copy goes.
    assert tables.upsert(quotes(spark, ("S0", 0, 1, 999)), path, S.PRICES, jobs.PRICE_ROW) == 1
    assert files.read_table(spark, path, S.PRICES).filter("symbol = 'S0' and date = '2024-01-01'").first().price == 1
    assert tables.write_partitioned(files.read_table(spark, path, S.PRICES), path) == 15
    assert left_in(scratch) == []


def test_a_failed_write_leaves_its_copy(spark, scratch, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    df = quotes(spark, ("A", 0, 1, 1))
    tables.write_partitioned(df, path)
    monkeypatch.setattr(tables, "_write", lambda *a, **k: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        tables.write_partitioned(files.read_table(spark, path, S.PRICES), path)
    assert len(left_in(scratch)) == 1


def test_a_folder_is_one_file_unless_it_is_big(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_partitioned(quotes(spark, *(("A", d % 4, d, d) for d in range(400))).repartition(7), path)
    listed = files.file_inventory(spark, path, "*.parquet").collect()
    assert [(r.files, r.bytes > 0) for r in listed] == [(1, True)] * 4


# --- gold from a day on --------------------------------------------------------


def gold_case(spark, tmp_path):
    silver, rng = str(tmp_path / "silver"), random.Random(4)
    days = {"often": range(0, 700), "seldom": range(0, 700, 90), "once": [3], "old": range(0, 40), "new": [695]}
    rows = [(s, d, rng.uniform(1, 9), d) for s, ds in days.items() for d in ds]
    rows += [("new", 696, 2.0, 1), ("once", 697, 3.0, 1)]
    df = quotes(spark, *rows)
    tables.write_partitioned(df, f"{silver}/prices", from_itself=False)
    return silver


def gold_rows(spark, gold, table, schema, since):
    df = files.read_table(spark, f"{gold}/{table}", schema).filter(F.col("date") >= since)
    value = "return_1d" if table == "returns_daily" else "volatility"
    return sorted((r.symbol, r.date, round(r[value], 9)) for r in df.collect())


def test_gold_since_equals_the_whole_run(spark, tmp_path):
    silver, whole, part = gold_case(spark, tmp_path), str(tmp_path / "w"), str(tmp_path / "p")
    since = "2025-11-20"  # day 689
    jobs.silver_to_gold(spark, silver, whole)
    jobs.silver_to_gold(spark, silver, part)
    before = {t: gold_rows(spark, part, t, s, "2000") for t, s in TABLES}
    jobs.silver_to_gold(spark, silver, part, since=since)
    for table, schema in TABLES:
        assert gold_rows(spark, part, table, schema, "2000") == before[table]
        assert gold_rows(spark, whole, table, schema, since) == gold_rows(spark, part, table, schema, since)
    assert any(s == "once" for s, _, _ in gold_rows(spark, part, "returns_daily", S.RETURNS, since))


TABLES = (("returns_daily", S.RETURNS), ("volatility_30d", S.VOLATILITY))


def test_gold_since_reads_its_days(spark, tmp_path, monkeypatch):
    silver = gold_case(spark, tmp_path)
    candles = spark.createDataFrame(
        [(DAY, "2024-01-01", "stock", "A", "1day", *(1.0,) * 5, "usd", "s", "r", DAY)], S.CANDLES
    )
    tables.write_partitioned(candles, f"{silver}/candles", from_itself=False)
    plans, counted = [], R.materialise
    monkeypatch.setattr(R, "materialise", lambda df: plans.append(plan_of(df)) or counted(df))
    recent = R.with_lead_in(jobs.silver_bars(spark, silver), "2025-11-20", 1, back_days=(64, 512))
    plans.append(plan_of(recent))
    scans = [line for p in plans for line in p.splitlines() if "FileScan parquet" in line and "pytest-of" in line]
    assert len(scans) >= 6
    assert all("(date" in line.split("PartitionFilters: [")[1].split("]")[0] for line in scans)
    found = {(r.symbol, r.date) for r in recent.filter("date < '2025-11-20'").collect()}
    assert found == {("often", "2025-11-19"), ("once", "2024-01-04")}


# --- spliced histories ---------------------------------------------------------


def versions(df):
    return sorted(
        (r.symbol, r.price, r.valid_from, r.valid_to, r.is_current) for r in df.collect()
    )


def plain_splice(stored, batch):
    """One key's versions [(start, price, stored)] after a batch of (time, price)."""
    taken = {t for t, _ in stored}
    rows = sorted([(t, p, True) for t, p in stored] + [(t, p, False) for t, p in batch if t not in taken])
    out = []
    for t, p, kept in rows:
        if out and out[-1][1] == p and not (kept and out[-1][2]):
            out[-1] = (out[-1][0], p, out[-1][2] or kept)
        else:
            out.append((t, p, kept))
    return [(t, p) for t, p, _ in out]


@pytest.mark.parametrize("seed", [1, 2])
def test_late_states_split_what_was_valid_then(spark, tmp_path, seed):
    rng, path = random.Random(seed), str(tmp_path / "h")
    known = {s: [] for s in "AB"}
    for _ in range(4):
        batch = [(rng.choice("AB"), rng.randrange(3), rng.choice([1, 2]), rng.randrange(60)) for _ in range(12)]
        batch = list({(s, m): (s, d, p, m) for s, d, p, m in batch}.values())
        tables.apply_versions(
            quotes(spark, *batch), path, S.PRICE_HISTORY, S.PRICE_VERSION_KEYS, ["price"],
            keep_all_versions=True, late="splice",
        )
        expected = []
        for s in known:
            known[s] = plain_splice(known[s], [(m, float(p)) for x, _, p, m in batch if x == s])
            times = [DAY + timedelta(days=400, minutes=t) for t, _ in known[s]] + [None]
            expected += [
                (s, p, times[k], times[k + 1], times[k + 1] is None) for k, (_, p) in enumerate(known[s])
            ]
        assert versions(files.read_table(spark, path, S.PRICE_HISTORY)) == sorted(expected)


def test_a_batch_stages_its_own_versions(spark, tmp_path, monkeypatch):
    path, stored = str(tmp_path / "h"), []
    every = {"keep_all_versions": True}
    apply = lambda *rows, **o: tables.apply_versions(
        quotes(spark, *rows), path, S.PRICE_HISTORY, S.PRICE_VERSION_KEYS, ["price"], **o
    )
    apply(*((f"S{k}", k % 3, 1, 1) for k in range(300)), **every)
    watch_copies(monkeypatch, stored)
    assert apply(("S7", 2, 5, 9), **every) == {"opened": 1, "closed": 1}
    assert [n for _, n in stored] == [2, 2]  # what changes, then what its two folders hold
    stored.clear()
    assert apply(("S7", 0, 3, 4), late="splice", **every) == {"opened": 1, "closed": 1}
    assert [n for _, n in stored] == [2, 2]


def test_splicing_without_stored_tables(spark):
    from tickstone.operators.history import scd2_apply

    old = scd2_apply(quotes(spark, ("A", 0, 1, 1), ("A", 0, 2, 5), ("B", 0, 1, 1)), None,
                     S.PRICE_VERSION_KEYS, ["price"], keep_all_versions=True)
    new = quotes(spark, ("A", 0, 2, 3), ("A", 0, 9, 2), ("A", 0, 7, 5), ("C", 0, 1, 1))
    late = scd2_apply(new, old, S.PRICE_VERSION_KEYS, ["price"], keep_all_versions=True, late="splice")
    assert [(s, p, f.minute, t and t.minute) for s, p, f, t, _ in versions(late)] == [
        ("A", 1.0, 1, 2), ("A", 2.0, 3, None), ("A", 9.0, 2, 3), ("B", 1.0, 1, None), ("C", 1.0, 1, None)
    ]


# --- files by bytes, manifests, inventory --------------------------------------


def test_files_stay_below_their_bound(spark, tmp_path):
    rng = random.Random(1)
    rows = [("d1", f"{k}", "x" * rng.randrange(300)) for k in range(3000)]
    rows += [("d1", f"big{k}", "y" * size) for k, size in enumerate((600, 900, 5000, 501))] + [("d2", "s", "z")] * 5
    df = spark.createDataFrame(rows, "folder string, id string, value string").withColumn(
        "size", F.octet_length("value").cast("bigint")
    )
    laid = layout.by_bytes(df, ["folder"], "size", 1000).withColumn("task", F.spark_partition_id())
    per_file = laid.groupBy("folder", "task").agg(F.sum("size").alias("bytes"), F.count("id").alias("n")).collect()
    assert sum(r.n for r in per_file) == len(rows)
    assert all(r.bytes <= 1000 or r.n == 1 for r in per_file)
    total = sum(len(v) for _, _, v in rows)
    assert len(per_file) < 4 * total / 1000
    assert layout.by_bytes(df, ["folder"], "size").columns == df.columns


def test_landed_files(spark, tmp_path):
    rows = [("s", "d", "r", "2024-01-01T00:00:00Z", json.dumps({"k": "v" * (k % 900)}), "2024-01-01") for k in range(400)]
    df = spark.createDataFrame(rows, "source string, dataset string, run_id string, ingest_ts string, data string, date string")
    land_bronze(df, str(tmp_path), "s", "d", file_bytes=20_000)
    listed = files.file_inventory(spark, str(tmp_path), "*.gz").collect()
    assert len(listed) == 1 and listed[0].files > 8
    found = spark.read.text(str(tmp_path), recursiveFileLookup=True)
    sizes = found.groupBy(F.input_file_name()).agg(F.sum(F.octet_length("value") + 1).alias("b")).collect()
    assert max(r.b for r in sizes) <= 20_000 and found.count() == 400


def test_inventory_opens_no_file(spark, tmp_path):
    (tmp_path / "a" / "b").mkdir(parents=True)
    (tmp_path / "a" / "blank.json").write_bytes(b"\n")
    (tmp_path / "a" / "b" / "broken.parquet").write_bytes(b"12345")
    listed = files.file_inventory(spark, str(tmp_path))
    found = {r.folder.rsplit("/", 1)[1]: (r.files, r.bytes) for r in listed.collect()}
    assert found == {"a": (1, 1), "b": (1, 5)}
    assert "content" not in plan_of(listed)
    assert files.file_inventory(spark, str(tmp_path / "none")).isEmpty()


def test_request_params_are_folded(spark):
    asked = "struct<symbol: string, outputsize: string>"
    df = spark.createDataFrame(
        [("r1", 'b"c', ["usd", "eur"], ("A", None)), ("r1", "a", ["usd"], ("A", "30")), ("r2", None, None, None)],
        f"run_id string, coin string, vs_currencies array<string>, request {asked}",
    ).selectExpr("*", "'s' source", "'d' dataset", "'2024' ingest_ts", "'2024-01-01' date")
    got = {r.run_id: r.request_params for r in L.run_manifest(df, params=L.request_params(df)).collect()}
    assert got["r1"] == '{"coin":["a","b\\"c"],"outputsize":"30","symbol":"A","vs_currencies":["eur","usd"]}'
    assert json.loads(got["r1"])["coin"] == ["a", 'b"c'] and got["r2"] == "{}"


def test_one_source_lists_its_own_folder(spark, tmp_path):
    for folder in S.SOURCE_FOLDERS.values():
        path = tmp_path / folder / "date=2024-01-01" / "run_id=r"
        path.mkdir(parents=True)
        (path / "x.gz").write_bytes(b"")
    for source, folder in S.SOURCE_FOLDERS.items():
        for day in (None, "2024-01-01"):
            listed = files.read_bronze(spark, str(tmp_path), date=day, source=source).inputFiles()
            assert len(listed) == 1 and folder in listed[0]
    assert len(files.read_bronze(spark, str(tmp_path), source="other").inputFiles()) == 4


# --- deep pages ----------------------------------------------------------------


def test_deep_pages_do_not_meet_in_one_task(spark):
    df = spark.range(20_000).selectExpr("if(id % 10 = 0, 'b', 'a') k", "id ts", "cast(id % 7 as string) v")
    df = df.unionByName(df.filter("k = 'a'").limit(5))
    cut = newest_per_key(df, ["k"], [F.col("ts").desc(), F.col("v")], 1500, long_series=4000)
    plain = newest_per_key(df, ["k"], [F.col("ts").desc(), F.col("v")], 1500, long_series=None)
    assert sorted(map(tuple, cut.collect())) == sorted(map(tuple, plain.collect()))
    assert "_part" in plan_of(cut) and "_part" not in plan_of(plain)
    few = newest_per_key(df, ["k"], [F.col("ts").desc()], 5)
    assert "_part" not in plan_of(few)
