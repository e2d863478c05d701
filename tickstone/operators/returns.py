"""Daily returns and rolling volatility.

A *bar* is one observation of a series: ``ts_utc``, the series key columns and
``close``.  Candles and quotes are brought to that one shape first, so the lag
and the rolling deviation share a single exchange.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import utc_day
from ..functions.scratch import materialise
from .series import LONG_SERIES_ROWS, along_series, newest_per_key, split_long_series

WINDOW_ROWS = 30
MIN_OBSERVATIONS = 10
# How many days back a run from a day on looks for the rows its windows reach.
BACK_DAYS = (64, 512)
_KEY = "_series"

_BAR = ("ts_utc", "asset_type", "symbol", "interval", "currency", "close", "source")


def _as_bars(df: DataFrame) -> DataFrame:
    # ``date`` is the partition column of stored tables; keeping it lets day
    # filters prune partitions.
    return df.select(*_BAR, *(c for c in ("date",) if c in df.columns))


def bars_from_candles(
    candles: DataFrame, interval: str | None = S.INTERVAL_CANDLE_DAY
) -> DataFrame:
    """Closing prices of the candles of one interval (``None``: of all)."""
    if interval is not None:
        candles = candles.filter(F.col("interval") == interval)
    return _as_bars(candles)


def prefer_currency(quotes: DataFrame, currency: str = "usd") -> DataFrame:
    """Of a symbol quoted in ``currency`` keep only those quotes; keep the
    quotes of other symbols as they are."""
    wanted = F.coalesce(F.lower("currency") == currency.lower(), F.lit(False))
    instrument = F.struct("asset_type", "symbol")
    has_it = quotes.filter(wanted).select(instrument.alias("_id")).distinct()
    has_it = has_it.withColumn("_has", F.lit(True))
    return (
        quotes.withColumn("_id", instrument)
        .join(has_it, "_id", "left")
        .filter(wanted | F.col("_has").isNull())
        .drop("_id", "_has")
    )


def bars_from_quotes(quotes: DataFrame, currency: str | None = None) -> DataFrame:
    """Quotes as bars, optionally with one preferred currency per symbol."""
    if currency is not None:
        quotes = prefer_currency(quotes, currency)
    return _as_bars(quotes.withColumn("close", F.col("price")))


def price_bars(
    candles: DataFrame, quotes: DataFrame, currency: str | None = None
) -> DataFrame:
    """Daily candles and quotes in one frame."""
    return bars_from_candles(candles).unionByName(bars_from_quotes(quotes, currency))


# --- windowed columns (on frames that may be split into chunks) ------------


def add_returns(bars: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``close_prev`` and ``return_1d``; rows without a return are dropped."""

    def lagged(df: DataFrame, by: list[str]) -> DataFrame:
        previous = F.lag("close").over(Window.partitionBy(*by).orderBy("ts_utc"))
        return df.withColumn("close_prev", previous)

    change = F.try_divide("close", "close_prev") - F.lit(1.0)
    return (
        along_series(bars, keys, 1, lagged)
        .withColumn("return_1d", change)
        .filter(F.col("return_1d").isNotNull())
    )


def rolling_volatility(by: Sequence[str], rows: int, min_obs: int):
    """Sample deviation of the last ``rows`` returns, null below ``min_obs``."""
    w = Window.partitionBy(*by).orderBy("ts_utc").rowsBetween(1 - rows, 0)
    return F.when(F.count("return_1d").over(w) >= min_obs, F.stddev_samp("return_1d").over(w))


def add_volatility(returns: DataFrame, keys: Sequence[str], rows: int, min_obs: int) -> DataFrame:
    """``volatility``; rows with too few observations are dropped."""

    def rolled(df: DataFrame, by: list[str]) -> DataFrame:
        return df.withColumn("volatility", rolling_volatility(by, rows, min_obs))

    return along_series(returns, keys, rows - 1, rolled).filter(F.col("volatility").isNotNull())


def _project(df: DataFrame, columns: Sequence[str], keys: Sequence[str]) -> DataFrame:
    extra = [k for k in keys if k not in columns]
    return df.withColumn("date", utc_day(df)).select(*columns, *extra)


def _returns_table(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return _project(
        df,
        ("ts_utc", "date", "asset_type", "symbol", "return_1d", "close", "close_prev", "source"),
        keys,
    )


def _volatility_table(df: DataFrame, keys: Sequence[str], rows: int) -> DataFrame:
    df = df.withColumn("window_days", F.lit(rows))
    return _project(
        df, ("ts_utc", "date", "asset_type", "symbol", "volatility", "window_days"), keys
    )


# --- tables ----------------------------------------------------------------


def returns(
    bars: DataFrame,
    keys: Sequence[str] | None = None,
    long_series: int | None = LONG_SERIES_ROWS,
) -> DataFrame:
    """Simple return of each bar over the one before it in its series.

    ``keys`` is the series key; ``("symbol",)`` gives one series per symbol
    across asset types, intervals and currencies.  The first bar of a series,
    and bars after a zero or missing close, have no return and are dropped.
    """
    keys = list(keys or S.series_keys(bars))
    bars = split_long_series(bars, keys, limit=long_series)
    return _returns_table(add_returns(bars, keys), keys)


def volatility(
    returns: DataFrame,
    window_rows: int = WINDOW_ROWS,
    min_obs: int = MIN_OBSERVATIONS,
    keys: Sequence[str] | None = None,
    long_series: int | None = LONG_SERIES_ROWS,
) -> DataFrame:
    """Rolling sample deviation of returns over the last ``window_rows`` rows.

    The window counts rows, not calendar days, although the result calls its
    length ``window_days``.
    """
    keys = list(keys or S.series_keys(returns))
    returns = split_long_series(returns, keys, limit=long_series)
    return _volatility_table(
        add_volatility(returns, keys, window_rows, min_obs), keys, window_rows
    )


def volatility_from_bars(
    bars: DataFrame,
    window_rows: int = WINDOW_ROWS,
    min_obs: int = MIN_OBSERVATIONS,
    keys: Sequence[str] | None = None,
    long_series: int | None = LONG_SERIES_ROWS,
) -> DataFrame:
    """Same as ``volatility(returns(bars))`` with one exchange for both."""
    keys = list(keys or S.series_keys(bars))
    bars = split_long_series(bars, keys, limit=long_series)
    df = add_volatility(add_returns(bars, keys), keys, window_rows, min_obs)
    return _volatility_table(df, keys, window_rows)


def with_lead_in(
    df: DataFrame, first_day: str, rows: int, keys: Sequence[str] | None = None,
    back_days: Sequence[int] = (), long_series: int | None = LONG_SERIES_ROWS,
) -> DataFrame:
    """The rows from ``first_day`` on and, for every series that has any, the ``rows``
    newest rows before it: what a window of that length needs to recompute those days.

    The lead-in is counted in rows per series, so gaps of any length are fine.  With
    ``back_days``, for stored tables, it is looked for in the last ``back_days[0]`` days
    first, then further back for the series that are still short of rows, at last in all
    days; a day filter reaches the scan each time, and a step that no series needs is
    not read.  Without, one pass over all days takes the rows before of every series;
    with ``long_series=None``, which says that all series are short, it is a pass in the
    order of the windows that follow, so that they share its exchange and its sort.
    """
    keys = list(keys or S.series_keys(df))
    day = F.col("date") if "date" in df.columns else utc_day(df)
    if not back_days and long_series is None:
        # An older row is among the newest unless so many older ones come after it.
        along = Window.partitionBy(*keys).orderBy("ts_utc")
        everywhere = along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        up_to_it = along.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        older = F.count(F.when(day < first_day, True))
        return (
            df.withColumn("_later", older.over(everywhere) - older.over(up_to_it))
            .filter((day >= first_day) | ((day < first_day) & (F.col("_later") < rows)))
            .drop("_later")
        )
    if not back_days:
        older = newest_per_key(df.filter(day < first_day), keys, [F.col("ts_utc").desc()], rows)
        return df.filter(day >= first_day).unionByName(older)
    key = F.struct(*keys).alias(_KEY)  # as a struct, null keys equal each other
    fresh = df.filter(day >= first_day)
    parts, short, until = [fresh], materialise(fresh.select(key).distinct()), first_day
    for back in (*back_days, None):
        older = df.filter(day < until)
        if back is not None:
            until = str(date.fromisoformat(first_day) - timedelta(days=back))
            older = older.filter(day >= until)
        # Stored, as it is small: it is counted here and windowed later.
        found = materialise(newest_per_key(
            older.withColumn(_KEY, key).join(short, _KEY, "left_semi"), [_KEY],
            [F.col("ts_utc").desc()], rows,
        ))
        parts.append(found.drop(_KEY))
        if back is None:
            break
        seen = parts[1].select(key)
        for more in parts[2:]:
            seen = seen.unionByName(more.select(key))
        enough = seen.groupBy(_KEY).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= rows)
        short = materialise(short.join(enough, _KEY, "left_anti"))
        if short.isEmpty():
            break
    lead = parts[1]
    for more in parts[2:]:
        lead = lead.unionByName(more)
    if len(parts) > 2:
        lead = newest_per_key(lead, keys, [F.col("ts_utc").desc()], rows)
    return fresh.unionByName(lead)


def returns_since(
    bars: DataFrame, first_day: str, back_days: Sequence[int] = (), **options
) -> DataFrame:
    """The rows of ``returns(bars)`` from ``first_day`` on, from those days'
    bars and one earlier bar per series."""
    recent = with_lead_in(
        bars, first_day, 1, options.get("keys"), back_days, options.get("long_series", LONG_SERIES_ROWS)
    )
    return returns(recent, **options).filter(F.col("date") >= first_day)


def volatility_since(
    returns: DataFrame, first_day: str, window_rows: int = WINDOW_ROWS,
    back_days: Sequence[int] = (), **options
) -> DataFrame:
    """The rows of ``volatility(returns)`` from ``first_day`` on, from those
    days' returns and ``window_rows - 1`` earlier ones per series."""
    recent = with_lead_in(
        returns, first_day, window_rows - 1, options.get("keys"), back_days,
        options.get("long_series", LONG_SERIES_ROWS),
    )
    return volatility(recent, window_rows, **options).filter(F.col("date") >= first_day)
