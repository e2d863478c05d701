"""Keeping one row per natural key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .series import newest_per_key


def dedupe_latest(
    df: DataFrame, keys: Sequence[str], newest_by: Sequence[str] = ("ingest_ts", "ts_utc")
) -> DataFrame:
    """The newest row per key; nulls in a key compare as equal.

    Rows that tie on ``newest_by`` are told apart by their remaining columns,
    so the choice does not depend on the order rows arrive in.
    """
    order = [c for c in newest_by if c in df.columns]
    rest = [c for c in df.columns if c not in order and c not in keys]
    newest_first = [F.col(c).desc_nulls_last() for c in order + rest]
    return newest_per_key(df, keys, newest_first)
