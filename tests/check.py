"""Compare registered queries with their SQL, run by DuckDB, on one data set.

    python tests/check.py [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, float):
        return v + 0.0  # -0.0 and 0.0 are one value
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(
        (tuple(plain(r[i]) for i in order) for r in rows),
        key=lambda r: tuple((v is not None, str(type(v)), str(v)) for v in r),
    )


def compare(spark, con, sf, name, make, sql):
    """None when equal, else what differs."""
    started = time.time()
    df = make(spark, sf)
    mine = rows_of(df.columns, [tuple(r) for r in df.collect()])
    took = time.time() - started
    if sql is None:
        return (None if mine else "no rows"), len(mine), took
    res = con.execute(sql)
    columns = [d[0] for d in res.description]
    theirs = rows_of(columns, res.fetchall())
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}", len(mine), took
    if mine != theirs:
        left, right = set(mine) - set(theirs), set(theirs) - set(mine)
        return (
            f"rows {len(mine)} != {len(theirs)}; {len(left)} / {len(right)} unmatched, "
            f"e.g. {sorted(left, key=str)[:2]} / {sorted(right, key=str)[:2]}",
            len(mine),
            took,
        )
    return None, len(mine), took


def main() -> int:
    from pyspark.sql import SparkSession

    from __spark_entry__ import oracle_sql, queries

    args = sys.argv[1:]
    sf = args[0] if args else "/root/testdata/sf0.01"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, bad = connect(sf), oracle_sql(), 0
    for name, make in queries().items():
        if args[1:] and name not in args[1:]:
            continue
        try:
            wrong, n, took = compare(spark, con, sf, name, make, sqls.get(name))
        except Exception as e:  # report and go on with the next query
            wrong, n, took = f"{type(e).__name__}: {str(e)[:600]}", 0, 0.0
        bad += wrong is not None
        kind = "sql " if name in sqls else "rows"
        print(f"{'ok  ' if wrong is None else 'FAIL'} {kind} {name:28} {n:8} rows {took:6.2f}s", wrong or "", flush=True)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
