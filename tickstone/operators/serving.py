"""Look-ups over the gold tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from .series import LONG_SERIES_ROWS, newest_per_key

PAGE_ROWS = 100
PAGE_MAX = 1000
CHART_ROWS = 180
CARD_ROWS = 5


def _where(df: DataFrame, **equals) -> DataFrame:
    """Rows equal to every given value; None means no restriction."""
    for column, value in equals.items():
        if value is not None:
            df = df.filter(F.col(column) == value)
    return df


def _newest(df: DataFrame, rows: int, **asked) -> tuple[DataFrame, list[str]]:
    """The newest rows of each series asked for, and the series keys left open."""
    open_keys = [k for k in S.series_keys(df) if asked.get(k) is None]
    newest_first = [F.col("ts_utc").desc(), *map(F.col, _tie_break(df))]
    found = _where(df, **asked)
    if open_keys:
        return newest_per_key(found, open_keys, newest_first, rows), open_keys
    return found.orderBy(*newest_first).limit(rows), open_keys


def latest_series(
    df: DataFrame, asset_type: str, symbol: str, limit: int = PAGE_ROWS,
    currency: str | None = None, interval: str | None = None,
) -> DataFrame:
    """The newest rows of one symbol, newest first.

    A symbol kept in several currencies or intervals has that many series; each has
    its own ``limit`` rows, one series after the other.
    """
    if not 0 <= limit <= PAGE_MAX:
        raise ValueError(f"limit must lie between 0 and {PAGE_MAX}")
    page, by = _newest(
        df, limit, asset_type=_given(asset_type), symbol=_given(symbol),
        currency=currency, interval=interval,
    )
    return page.orderBy(*by, F.col("ts_utc").desc(), *_tie_break(df))


def chart_series(
    df: DataFrame, asset_type: str, symbol: str, rows: int = CHART_ROWS,
    currency: str | None = None, interval: str | None = None,
) -> DataFrame:
    """The newest rows of one symbol, each series by itself, oldest first."""
    shown, by = _newest(
        df, rows, asset_type=_given(asset_type), symbol=_given(symbol),
        currency=currency, interval=interval,
    )
    return shown.orderBy(*by, F.col("ts_utc"), *_tie_break(df))


def _given(value: str) -> str:
    if value is None:
        raise ValueError("an asset type and a symbol must be given")
    return value


def _tie_break(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c != "ts_utc"]


def series_topk(
    df: DataFrame, k: int, keys: Sequence[str] | None = None,
    long_series: int | None = LONG_SERIES_ROWS,
) -> DataFrame:
    """The ``k`` newest rows of every series at once; rows of one instant are told apart
    by their other columns."""
    keys = list(keys or S.series_keys(df))
    order = [F.col("ts_utc").desc(), *(F.col(c) for c in _tie_break(df))]
    return newest_per_key(df, keys, order, k, long_series)


def symbols(df: DataFrame, asset_type: str | None = None) -> DataFrame:
    """The instruments a table covers, in order."""
    listed = _where(df, asset_type=asset_type).select("asset_type", "symbol").distinct()
    return listed.orderBy("asset_type", "symbol")


def predictions_lookup(
    predictions: DataFrame, asset_type: str | None = None, symbol: str | None = None
) -> DataFrame:
    """Predictions of an asset type, a symbol, both or all."""
    return _where(predictions, asset_type=asset_type, symbol=symbol)


def first_predictions(predictions: DataFrame, n: int = CARD_ROWS) -> DataFrame:
    """The first predictions in order of series."""
    return predictions.orderBy(*S.series_keys(predictions)).limit(n)


def recommendation(
    returns: DataFrame, asset_type: str, symbol: str,
    currency: str | None = None, interval: str | None = None,
) -> DataFrame:
    """The trend signal of each series of one symbol; one row even for an unknown
    symbol, with the remaining series keys null."""
    from .signals import INSUFFICIENT, trend_signal

    wanted = {"asset_type": _given(asset_type), "symbol": _given(symbol)}
    found = trend_signal(_where(returns, **wanted, currency=currency, interval=interval))
    asked = returns.sparkSession.range(1).select(*(F.lit(v).alias(k) for k, v in wanted.items()))
    return asked.join(found, list(wanted), "left").withColumn(
        "action", F.coalesce("action", F.lit(INSUFFICIENT))
    )
