"""Text that used to lose rows, session zones, manifests and stored histories."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tickstone import schemas as S
from tickstone.functions import instant, number, wall_clock_utc
from tickstone.operators.ledger import run_manifest
from tickstone.sinks.tables import apply_versions
from tickstone.sources.files import read_table


@pytest.mark.parametrize(("text", "value"), [
    ("1e100", 1e100), ("1E+120", 1e120), (" 2.5 ", 2.5), ("-.5e-3", -0.0005), ("1e308", 1e308),
    ("1e400", None), ("Infinity", None), ("NaN", None), ("", None), (" ", None), ("1 2", None),
    ("12abc", None), ("1d", None), ("0x10", None), (None, None), ("e5", None),
])
def test_number(spark, text, value):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(number(F.col("t"))).first()[0] == value


@pytest.mark.parametrize(("text", "utc"), [
    ("2024-01-05 10:30", "2024-01-05 10:30:00"), ("2024-01-05T10:30", "2024-01-05 10:30:00"),
    ("2024-01", "2024-01-01 00:00:00"), ("2024-01-05", "2024-01-05 00:00:00"),
    ("2024-01-05T10:30+02:00", "2024-01-05 08:30:00"), ("2024-01-05 10:30:15", "2024-01-05 10:30:15"),
    ("2024-01-05T10:30:15.25Z", "2024-01-05 10:30:15.25"), ("2024-01-05T10:30Z", "2024-01-05 10:30:00"),
    ("2024-01-05T10:30:15-05:00", "2024-01-05 15:30:15"),
    ("2024", "2024-01-01 00:00:00"), ("2024-01-05 10", "2024-01-05 10:00:00"),
    ("2024-01-05T10", "2024-01-05 10:00:00"), ("2024-1-5 1:2:3", "2024-01-05 01:02:03"),
    ("2024-01-05T10:30:15 Europe/Paris", "2024-01-05 09:30:15"), (" 2024-01-05T10:30:15+0100 ", "2024-01-05 09:30:15"),
    ("2024-01-05T10:30:15.", "2024-01-05 10:30:15"), ("2024-01-05T10:30 PST", "2024-01-05 18:30:00"),
    ("2024-01-05T", None), ("2024-01-05T10:30:15N", None), ("2024-01-05T10Z", None), ("2024-01-05Z", None),
    ("10:30:00Z", None), ("T10:30", None), ("10:30Z", None), ("2024-02-30", None), ("2024-01-05T24:00:00", None),
    ("300000-01-01", None), ("20240105", None), ("x 10:30Z", None),
    ("10:30:00", None), ("10:30", None), ("junk", None), ("", None), (None, None), ("2024-13-05", None),
])
@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_instant(spark, text, utc, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([(text,)], "t string").select(instant(F.col("t")).alias("ts"))
        got = df.select(wall_clock_utc(F.col("ts")).cast("string")).first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == utc


def test_two_instants_of_one_wall_clock_stay_apart(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.sql(
            "select timestamp'2024-11-03 05:30:00Z' a, timestamp'2024-11-03 06:30:00Z' b, timestamp'1965-03-01 00:00:01Z' c"
        )
        got = df.select(*(wall_clock_utc(F.col(x)).cast("string") for x in "abc")).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert tuple(got) == ("2024-11-03 05:30:00", "2024-11-03 06:30:00", "1965-03-01 00:00:01")


def test_one_manifest_per_run(spark):
    rows = [("r1", "s", "d", f"2024-01-01T00:00:0{i}Z", "2024-01-01") for i in (2, 1, 3)]
    df = spark.createDataFrame(rows, "run_id string, source string, dataset string, ingest_ts string, date string")
    assert [tuple(r) for r in run_manifest(df).collect()] == [
        ("r1", "s", "d", "2024-01-01T00:00:01Z", "2024-01-01", 3, "success")
    ]


KEYS, TRACKED = ["asset_type", "symbol"], ["price"]


def batch(spark, *rows):
    """(symbol, price, minute)"""
    made = [
        (datetime(2024, 1, 1), "2024-01-01", "crypto", s, "1d", "usd", p, "src", "r", datetime(2024, 1, 1, 0, m))
        for s, p, m in rows
    ]
    return spark.createDataFrame(made, S.PRICES)


def versions(spark, path):
    rows = read_table(spark, path, schema()).collect()
    return sorted(
        (r.symbol, r.price, r.valid_from.minute, r.valid_to and r.valid_to.minute, r.is_current) for r in rows
    )


def schema():
    from pyspark.sql import types as T

    out = T.StructType(list(S.PRICES.fields))
    return out.add("hash_diff", "string").add("valid_from", "timestamp").add("valid_to", "timestamp").add("is_current", "boolean")


def apply(spark, path, rows, **options):
    return apply_versions(batch(spark, *rows), path, schema(), KEYS, TRACKED, **options)


def test_stored_history_with_late_rows(spark, tmp_path):
    path = str(tmp_path / "h")
    apply(spark, path, [("A", 1.0, 5)], late="apply")
    assert apply(spark, path, [("A", 2.0, 3)]) == {"opened": 0, "closed": 0}
    assert apply(spark, path, [("A", 2.0, 7), ("B", 1.0, 7)], late="apply") == {"opened": 2, "closed": 1}
    assert versions(spark, path) == [("A", 1.0, 5, 7, False), ("A", 2.0, 7, None, True), ("B", 1.0, 7, None, True)]


def test_stored_history_with_all_versions(spark, tmp_path):
    path = str(tmp_path / "h")
    every = {"keep_all_versions": True}
    apply(spark, path, [("A", 1.0, 1), ("A", 2.0, 2)], **every)
    got = apply(spark, path, [("A", 2.0, 3), ("A", 3.0, 4), ("A", 4.0, 5), ("B", 1.0, 5)], **every)
    assert got == {"opened": 3, "closed": 1}
    assert apply(spark, path, [("A", 4.0, 5)], **every) == {"opened": 0, "closed": 0}
    assert [v for v in versions(spark, path) if v[0] == "A"] == [
        ("A", 1.0, 1, 2, False), ("A", 2.0, 2, 4, False), ("A", 3.0, 4, 5, False), ("A", 4.0, 5, None, True)
    ]
    with pytest.raises(ValueError, match="late"):
        apply(spark, path, [("A", 9.0, 9)], late="apply", **every)


def test_null_key_meets_its_stored_version(spark, tmp_path):
    path = str(tmp_path / "h")
    for minute, price in ((1, 1.0), (2, 2.0), (3, 3.0)):
        apply(spark, path, [(None, price, minute)])
    assert [v[4] for v in versions(spark, path)].count(True) == 1
