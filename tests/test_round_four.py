"""What the fourth review found: files of small bounds, bronze of several datasets, long series in gold."""

from __future__ import annotations

import gzip
import json

from pyspark.sql import functions as F

from tickstone import schemas as S
from tickstone.plans import jobs
from tickstone.sinks import layout, tables
from tickstone.sinks.landing import land_bronze
from tickstone.sources import files


def test_small_files_of_like_rows_are_full(spark, tmp_path):
    rows = [("s", "d", None, f'{{"k":{1000 + k % 3}}}', f"2024-01-0{1 + k // 1900}") for k in range(2000)]
    rows += [("s", "d", "r", None, None)] * 3
    df = spark.createDataFrame(rows, "source string, dataset string, run_id string, data string, date string")
    land_bronze(df, str(tmp_path), "s", "d", file_bytes=1000)
    found = spark.read.text(str(tmp_path), recursiveFileLookup=True).select(
        F.octet_length("value").alias("size"), F.col("_metadata.file_path").alias("file")
    )
    per_file = found.groupBy("file").agg(F.sum(F.col("size") + 1).alias("bytes"), F.count("size").alias("n")).collect()
    assert sum(r.n for r in per_file) == len(rows)
    assert max(r.bytes for r in per_file) <= 1000
    assert len(per_file) < 1.5 * sum(r.bytes for r in per_file) / 1000
    listed = files.file_inventory(spark, str(tmp_path), "*.gz")
    assert listed.count() == 3 and listed.agg(F.sum("files")).first()[0] == len(per_file)


def test_rows_of_unlike_size_are_cut_by_bytes(spark):
    df = spark.createDataFrame([("a", f"{k}", 1 + k % 400) for k in range(3000)], "f string, id string, size bigint")
    laid, most = layout.in_files(df, ["f"], "size", 1000)
    assert most == 0
    tasks = laid.groupBy(F.spark_partition_id()).agg(F.sum("size").alias("bytes"), F.count("id").alias("n")).collect()
    assert sum(r.n for r in tasks) == 3000 and max(r.bytes for r in tasks) <= 1000
    assert len(tasks) < 4 * sum(r.bytes for r in tasks) / 1000
    big, most = layout.in_files(df, ["f"], "size")
    assert most == 0 and big.rdd.getNumPartitions() == 1


def put(path, *records):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(gzip.compress("\n".join(json.dumps(r) for r in records).encode()))


def test_datasets_are_dealt_to_tasks_by_themselves(spark, tmp_path):
    for k, folder in enumerate(S.SOURCE_FOLDERS.values()):
        put(tmp_path / folder / "date=2024-01-01" / "run_id=r" / "x.gz", {"source": f"s{k}", "data": {"k": k}})
    put(tmp_path / "a b" / "c%d" / "x.gz", {"source": "s9"}, {"source": None})

    def rows(root):
        return sorted((r.source or "", r.data or "", r.input_file) for r in files.read_bronze(spark, str(root)).collect())

    apart = rows(tmp_path)
    assert files.read_bronze(spark, str(tmp_path)).rdd.getNumPartitions() == 5
    assert len(apart) == 6 and len({f for *_, f in apart}) == 5
    put(tmp_path / "stray.gz", {"source": "s8"})  # now all are read as one
    assert [r for r in rows(tmp_path) if r[0] != "s8"] == apart and len(rows(tmp_path)) == 7
    assert files._datasets(spark, str(tmp_path)) == files._datasets(spark, str(tmp_path / "none")) == []
    put(tmp_path / "more" / "_hidden" / "x.gz", {"source": "s7"})
    put(tmp_path / "more" / "sh[o]wn" / "x.gz", {"source": "s6"})
    (tmp_path / "stray.gz").unlink()
    assert [r for r in rows(tmp_path) if r[0] != "s6"] == apart and len(rows(tmp_path)) == 7


def test_lines_are_spliced_as_before(spark, tmp_path):
    rows = [('a"}', '{"k":\r\n\n 1}'), ("b", None), (None, '{"k":"\\n}"}'), ("c", "[\n]")]
    df = spark.createDataFrame(rows, "source string, data string").selectExpr(
        "*", "named_struct('symbol', 'x') request", "'r' run_id", "'d' date"
    )
    land_bronze(df, str(tmp_path), "s", "d")
    found = {r[0] for r in spark.read.text(str(tmp_path), recursiveFileLookup=True).collect()}
    tail = '"request":{"symbol":"x"},"run_id":"r","data":'
    assert found == {
        '{"source":"a\\"}",' + tail + '{"k":  1}}', '{"source":"b",' + tail + "null}",
        "{" + tail + '{"k":"\\n}"}}', '{"source":"c",' + tail + "[ ]}",
    }


def silver_of(spark, path, n=300):
    quote = spark.range(n).selectExpr(
        "timestamp_seconds(1704067200 + (id div 3) * 3600) ts_utc", "'crypto' asset_type",
        "if(id % 3 = 0, 'a', 'b') symbol", "'spot' interval", "if(id % 3 = 1, null, 'usd') currency",
        "cast(100 + id * 7919 % 31 as double) price", "'s' source", "'r' run_id", "timestamp_seconds(id) ingest_ts",
    ).withColumn("date", F.date_format("ts_utc", "yyyy-MM-dd"))
    tables.write_partitioned(quote.select(*S.PRICES.fieldNames()), f"{path}/prices")


def test_newest_bars_are_found_once(spark, tmp_path, monkeypatch):
    silver_of(spark, tmp_path)
    made, seen = jobs.returns, []
    monkeypatch.setattr(jobs, "returns", lambda bars: seen.append(bars._jdf.queryExecution().toString()) or made(bars))
    counts = jobs.silver_to_gold(spark, str(tmp_path), str(tmp_path / "gold"))
    assert counts["returns_daily"] == 297 and len(seen) == 1 and "Window" not in seen[0]


def test_a_fit_cuts_its_series(spark, tmp_path, monkeypatch):
    silver_of(spark, tmp_path)
    jobs.silver_to_gold(spark, str(tmp_path), str(tmp_path / "gold"))

    def fitted():
        df = jobs.predict(spark, str(tmp_path / "gold"), alpha=0.0001).drop("generated_at")
        return df.withColumn("prediction_return", F.round("prediction_return", 9)).orderBy("symbol", "currency").collect()

    whole, cut = fitted(), []
    split = jobs.features

    def features(*args, **options):
        cut.append("_chunk" in (df := split(*args, **options))._jdf.queryExecution().toString())
        return df

    monkeypatch.setattr(jobs, "features", features)
    monkeypatch.setattr(jobs, "FIT_ROWS", 40)
    assert fitted() == whole and len(whole) == 3 and cut == [True]
