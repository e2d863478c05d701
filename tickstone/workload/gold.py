"""Queries over returns and volatility."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import returns as R
from . import bindings as B
from .registry import query

RETURN_COLUMNS = 'ts_utc, "date", asset_type, symbol, "interval", currency, source'
RETURN_NUMBERS = '"close", close_prev, return_1d'
_RETURNS_OUT = f"SELECT {RETURN_COLUMNS}, {RETURN_NUMBERS} FROM r"


def _volatility_out(digits: int, rows: int = 30, columns: str = B.SERIES) -> str:
    return f"""SELECT ts_utc, "date", {columns}, round(volatility, {digits}) AS volatility,
    CAST({rows} AS INTEGER) AS window_days FROM v"""


_BY_SYMBOL = "asset_type, symbol"
CANDLE_RETURNS = f"WITH {B.CANDLES_SQL}, {B.returns_sql('c', '\"close\"', B.SERIES)}"
QUOTE_RETURNS = f"WITH {B.QUOTES_SQL}, {B.returns_sql('q', 'price', B.SERIES)}"
CURRENCY_QUOTES = """
q AS (SELECT ts AS ts_utc, event_type AS asset_type, CAST(user_id AS VARCHAR) AS symbol,
             'spot' AS "interval", "value" AS price, 'events' AS source,
             CASE event_id % 3 WHEN 0 THEN 'USD' WHEN 1 THEN 'eur' ELSE 'gbp' END AS currency
      FROM events)"""


def daily_bars(spark, sf):
    return R.bars_from_candles(B.candles(spark, sf))


def quote_bars(spark, sf):
    return R.bars_from_quotes(B.quotes(spark, sf))


@query(f"{CANDLE_RETURNS} {_RETURNS_OUT}")
def returns_candles(spark, sf):
    return R.returns(daily_bars(spark, sf), long_series=None)


@query(f"{QUOTE_RETURNS} {_RETURNS_OUT}")
def returns_quotes(spark, sf):
    return R.returns(quote_bars(spark, sf))


@query(f"""
WITH {CURRENCY_QUOTES}, {B.returns_sql('q', 'price', B.SERIES)} {_RETURNS_OUT}""")
def returns_all_currencies(spark, sf):
    quotes = B.quotes(spark, sf, F.col("event_type"), currency=B.three_currencies())
    return R.returns(R.bars_from_quotes(quotes))


@query(f"""
WITH {CURRENCY_QUOTES},
kept AS (SELECT * FROM q WHERE lower(currency) = 'usd' OR NOT EXISTS (
           SELECT 1 FROM q u WHERE u.asset_type = q.asset_type AND u.symbol = q.symbol
             AND lower(u.currency) = 'usd')),
{B.returns_sql('kept', 'price', B.SERIES)} {_RETURNS_OUT}""")
def returns_usd_preferred(spark, sf):
    quotes = B.quotes(spark, sf, F.col("event_type"), currency=B.three_currencies())
    return R.returns(R.bars_from_quotes(quotes, "usd"))


@query(f"""
WITH {CURRENCY_QUOTES}, {B.returns_sql('q', 'price', 'symbol')}
SELECT ts_utc, "date", asset_type, symbol, source, {RETURN_NUMBERS} FROM r""")
def returns_by_symbol(spark, sf):
    """One series per symbol, whatever its asset type and currency."""
    quotes = B.quotes(spark, sf, F.col("event_type"), currency=B.three_currencies())
    return R.returns(R.bars_from_quotes(quotes), keys=["symbol"])


@query(f"{CANDLE_RETURNS}, {B.volatility_sql(B.SERIES)} {_volatility_out(6)}")
def volatility_30(spark, sf):
    return B.rounded(R.volatility_from_bars(daily_bars(spark, sf), long_series=None), 6, "volatility")


@query(f"{QUOTE_RETURNS}, {B.volatility_sql(B.SERIES)} {_volatility_out(4)}")
def volatility_quotes(spark, sf):
    return B.rounded(R.volatility_from_bars(quote_bars(spark, sf)), 4, "volatility")


@query(f"""
WITH {CURRENCY_QUOTES}, {B.returns_sql('q', 'price', 'symbol')}, {B.volatility_sql('symbol')}
{_volatility_out(4, columns=_BY_SYMBOL)}""")
def volatility_by_symbol(spark, sf):
    quotes = B.quotes(spark, sf, F.col("event_type"), currency=B.three_currencies())
    return B.rounded(R.volatility_from_bars(R.bars_from_quotes(quotes), keys=["symbol"]), 4, "volatility")


@query(f"""
WITH q AS (SELECT ts AS ts_utc, event_type AS asset_type, CAST(user_id AS VARCHAR) AS symbol,
                  'spot' AS "interval", 'usd' AS currency, "value" AS price, 'events' AS source
           FROM events),
{B.returns_sql('q', 'price', B.SERIES)}, {B.volatility_sql(B.SERIES, 12, 10)}
{_volatility_out(4, 12)}""")
def volatility_min_obs_edge(spark, sf):
    """Short series, many of them just below or above the required count."""
    bars = R.bars_from_quotes(B.quotes(spark, sf, F.col("event_type")))
    return B.rounded(R.volatility_from_bars(bars, window_rows=12, min_obs=10), 4, "volatility")


@query(f"""
WITH {B.CANDLES_SQL}, {B.QUOTES_SQL},
both_kinds AS (SELECT ts_utc, asset_type, symbol, "interval", currency, "close", source FROM c
               UNION ALL
               SELECT ts_utc, asset_type, symbol, "interval", currency, price, source FROM q),
{B.returns_sql('both_kinds', '"close"', B.SERIES)}, {B.volatility_sql(B.SERIES)}
{_volatility_out(4)}""")
def volatility_all_bars(spark, sf):
    """Candles and quotes together: one exchange for both kinds and windows."""
    bars = R.price_bars(B.candles(spark, sf), B.quotes(spark, sf))
    return B.rounded(R.volatility_from_bars(bars), 4, "volatility")


@query(f"{CANDLE_RETURNS} {_RETURNS_OUT} WHERE \"date\" >= '1999-01-01'")
def returns_since(spark, sf):
    return R.returns_since(daily_bars(spark, sf), "1999-01-01", long_series=None)


@query(
    f"{CANDLE_RETURNS}, {B.volatility_sql(B.SERIES)} "
    f"{_volatility_out(6)} WHERE \"date\" >= '1999-01-01'"
)
def volatility_since(spark, sf):
    made = R.returns(daily_bars(spark, sf), long_series=None)
    return B.rounded(R.volatility_since(made, "1999-01-01", long_series=None), 6, "volatility")


FEW_SERIES = f"""
WITH q AS (SELECT ts AS ts_utc, 'event' AS asset_type, event_type AS symbol,
                  'spot' AS "interval", 'usd' AS currency, "value" AS price, 'events' AS source
           FROM events), {B.returns_sql('q', 'price', B.SERIES)}"""


def few_series(spark, sf):
    """Five series that hold all rows, and a limit that makes all of them long."""
    bars = R.bars_from_quotes(B.quotes(spark, sf, symbol="event_type"))
    return bars, max(bars.count() // 40, 1)


@query(f"{FEW_SERIES}, {B.volatility_sql(B.SERIES)} {_volatility_out(4)}")
def volatility_long_series(spark, sf):
    """Long series cut into chunks that carry the rows their windows reach."""
    bars, limit = few_series(spark, sf)
    return B.rounded(R.volatility_from_bars(bars, long_series=limit), 4, "volatility")
