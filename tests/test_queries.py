"""Every registered query against its SQL on the smallest tables."""

import pytest
from check import compare, connect

from __spark_entry__ import entry, oracle_sql, queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_sql_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    df = entry(spark)
    assert df.columns[:3] == ["ts_utc", "date", "asset_type"]
    assert df.limit(1).count() == 1


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, con, name):
    wrong, _, _ = compare(spark, con, SF, name, queries()[name], oracle_sql().get(name))
    assert wrong is None
