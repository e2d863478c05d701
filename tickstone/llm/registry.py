"""Registered queries of this subpackage and, where SQL can say the same, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function under its own name."""

    def register(make):
        QUERIES[make.__name__] = make
        if sql is not None:
            SQL[make.__name__] = sql
        return make

    return register
