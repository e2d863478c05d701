"""Versioned history: every case of an incoming row, and its invariants."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tickstone.functions import row_hash, row_hash_plain
from tickstone.operators import history as H

KEYS = ["asset_type", "symbol", "currency"]
SCHEMA = (
    "asset_type string, symbol string, currency string, price double, ts_utc timestamp_ntz, "
    "ingest_ts timestamp_ntz"
)
DAY = datetime(2024, 1, 1)


def at(hours):
    return DAY + timedelta(hours=hours)


def rows(spark, *specs):
    made = [("c", s, cur, p, at(h), at(h)) for s, cur, p, h in specs]
    return spark.createDataFrame(made, SCHEMA)


def versions(df):
    shown = df.select("symbol", "currency", "price", "valid_from", "valid_to", "is_current")
    return sorted(map(tuple, shown.collect()), key=str)


def apply(new, old, **more):
    return H.scd2_apply(new, old, KEYS, ["price"], **more)


def test_every_case_at_once(spark):
    old = apply(rows(
        spark, ("same", "usd", 1.0, 1), ("moved", "usd", 1.0, 1), ("gone", "usd", 1.0, 1),
        ("late", "usd", 1.0, 9), ("nokey", None, 1.0, 1), ("noprice", "usd", None, 1),
    ), None)
    new = rows(
        spark, ("same", "usd", 1.0, 5), ("moved", "usd", 2.0, 5), ("new", "usd", 1.0, 5),
        ("late", "usd", 2.0, 5), ("nokey", None, 1.0, 5), ("noprice", "usd", 3.0, 5),
        ("moved", "usd", 7.0, 4),
    )
    assert versions(apply(new, old)) == sorted([
        ("same", "usd", 1.0, at(1), None, True),
        ("moved", "usd", 1.0, at(1), at(5), False),
        ("moved", "usd", 2.0, at(5), None, True),
        ("gone", "usd", 1.0, at(1), None, True),
        ("late", "usd", 1.0, at(9), None, True),
        ("nokey", None, 1.0, at(1), None, True),
        ("noprice", "usd", None, at(1), at(5), False),
        ("noprice", "usd", 3.0, at(5), None, True),
        ("new", "usd", 1.0, at(5), None, True),
    ], key=str)


def test_late_rows_can_be_applied(spark):
    old = apply(rows(spark, ("a", "usd", 1.0, 9)), None)
    out = versions(apply(rows(spark, ("a", "usd", 2.0, 5)), old, late="apply"))
    assert ("a", "usd", 2.0, at(5), None, True) in out
    with pytest.raises(ValueError):
        apply(rows(spark, ("a", "usd", 2.0, 5)), old, late="maybe")


def test_closed_versions_and_null_flags_stay(spark):
    one = apply(rows(spark, ("a", "usd", 1.0, 1)), None)
    two = apply(rows(spark, ("a", "usd", 2.0, 2)), one)
    odd = two.withColumn("is_current", F.when(F.col("is_current"), True))  # false becomes null
    three = versions(apply(rows(spark, ("a", "usd", 3.0, 3)), odd))
    assert three == versions(apply(rows(spark, ("a", "usd", 3.0, 3)), two))
    assert len(three) == 3


def test_history_without_hash_counts_as_changed(spark):
    old = apply(rows(spark, ("a", "usd", 1.0, 1)), None)
    blank = old.withColumn("hash_diff", F.lit(None).cast("string"))
    assert len(versions(apply(rows(spark, ("a", "usd", 1.0, 2)), blank))) == 2


@pytest.mark.parametrize("everything", [False, True])
def test_invariants_over_random_batches(spark, everything):
    rng = random.Random(7)
    history = None
    for batch in range(3):
        specs = [
            (rng.choice("abcd"), rng.choice(["usd", None]), float(rng.randrange(3)),
             batch * 50 + rng.randrange(50))
            for _ in range(60)
        ]
        made = rows(spark, *specs)
        history = apply(made, history, keep_all_versions=everything)
        again = apply(made, history, keep_all_versions=everything)
        assert versions(again) == versions(history)
        history = history.checkpoint()
    by_key = {}
    for s, cur, price, start, end, current in versions(history):
        by_key.setdefault((s, cur), []).append((start, end, current, price))
    for found in by_key.values():
        found.sort(key=lambda v: v[0])
        assert [v[2] for v in found] == [False] * (len(found) - 1) + [True]
        for a, b in zip(found, found[1:]):
            assert a[0] < a[1] <= b[0]
            if everything:
                assert a[1] == b[0] and a[3] != b[3]


def test_one_join_without_nested_loops(spark):
    old = apply(rows(spark, ("a", "usd", 1.0, 1)), None)
    plan = apply(rows(spark, ("a", "usd", 2.0, 2)), old)._jdf.queryExecution().executedPlan()
    text = plan.toString()
    assert text.count("SortMergeJoin") == 1
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_hash_tells_values_apart(spark):
    df = spark.createDataFrame(
        [("a", None), ("a", ""), (None, "a"), ("a||", "b"), ("a", "||b"), ("a|1:b", ""), ("-", "-"),
         (None, None)], "x string, y string"
    )
    safe = {r[0] for r in df.select(row_hash(["x", "y"])).collect()}
    plain = {r[0] for r in df.select(row_hash_plain(["x", "y"])).collect()}
    assert len(safe) == 8 and len(plain) < 8
