"""Queries over the trend signal, features and predictions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import returns as R
from ..operators import serving as V
from ..operators import signals as G
from . import bindings as B
from .gold import (
    CANDLE_RETURNS,
    CURRENCY_QUOTES,
    FEW_SERIES,
    QUOTE_RETURNS,
    daily_bars,
    few_series,
    quote_bars,
)
from .registry import query


def _trend_sql(least: int = 5, digits: int = 6) -> str:
    return f"""
t AS (SELECT *, row_number() OVER (PARTITION BY {B.SERIES} ORDER BY ts_utc DESC) AS rn FROM r),
s AS (SELECT {B.SERIES}, count(*) AS n, regr_slope("close", -rn) AS slope,
             arg_min("close", rn) AS last_close FROM t WHERE rn <= 30 GROUP BY ALL),
u AS (SELECT *, CASE WHEN last_close = 0 THEN 0 ELSE slope / nullif(last_close, 0) END AS rel
      FROM s),
g AS (SELECT {B.SERIES},
             CASE WHEN n < {least} THEN 'insufficient-data' WHEN rel > 0.002 THEN 'buy'
                  WHEN rel < -0.002 THEN 'sell' ELSE 'hold' END AS action,
             CASE WHEN n >= {least} THEN round(slope, {digits}) END AS slope,
             CASE WHEN n >= {least} THEN round(rel, {digits}) END AS rel_slope,
             CASE WHEN n >= {least} THEN last_close END AS last_close FROM u)"""


@query(f"{CANDLE_RETURNS}, {_trend_sql(digits=4)} SELECT * FROM g")
def trend_signal(spark, sf):
    made = R.returns(daily_bars(spark, sf), long_series=None)
    return B.rounded(G.trend_signal(made), 4, "slope", "rel_slope")


@query(f"""
WITH q AS (SELECT ts AS ts_utc, event_type AS asset_type, CAST(user_id AS VARCHAR) AS symbol,
                  'spot' AS "interval", 'usd' AS currency, "value" AS price, 'events' AS source
           FROM events),
{B.returns_sql('q', 'price', B.SERIES)}, {_trend_sql(12)} SELECT * FROM g""")
def trend_signal_short(spark, sf):
    """Series around the number of closes that a signal needs."""
    made = R.returns(R.bars_from_quotes(B.quotes(spark, sf, F.col("event_type"))))
    return B.rounded(G.trend_signal(made, min_closes=12), 6, "slope", "rel_slope")


@query(f"""{QUOTE_RETURNS}, {_trend_sql()}
SELECT asset_type, symbol, action, slope, rel_slope, last_close FROM g WHERE symbol = '7'""")
def recommendation(spark, sf):
    made = R.returns(quote_bars(spark, sf))
    made = V.recommendation(made, "event", "7").drop("interval", "currency")
    return B.rounded(made, 6, "slope", "rel_slope")


@query(f"""
WITH {CURRENCY_QUOTES}, {B.returns_sql('q', 'price', B.SERIES)}, {_trend_sql()}
SELECT * FROM g WHERE asset_type = 'view' AND symbol = '7'""")
def recommendation_currencies(spark, sf):
    """A symbol quoted in three currencies has a signal in each."""
    quotes = B.quotes(spark, sf, F.col("event_type"), currency=B.three_currencies())
    made = V.recommendation(R.returns(R.bars_from_quotes(quotes)), "view", "7")
    return B.rounded(made, 6, "slope", "rel_slope")


def _features_sql(horizon: int = 0) -> str:
    lags = ", ".join(f"lag(return_1d, {i}) OVER w AS ret_lag_{i}" for i in range(1, 6))
    vols = ", ".join(f"lag(volatility, {i}) OVER w AS vol_lag_{i}" for i in range(3))
    rolling = ", ".join(
        f"CASE WHEN count(return_1d) OVER w{k} = {k} THEN {f}(return_1d) OVER w{k} END AS ret_{n}_{k}"
        for k in (5, 10)
        for n, f in (("mean", "avg"), ("std", "stddev_samp"))
    )
    target = f"lead(return_1d, {horizon}) OVER w" if horizon else "return_1d"
    frames = ", ".join(
        f"w{k} AS (PARTITION BY {B.SERIES} ORDER BY ts_utc ROWS BETWEEN {k - 1} PRECEDING "
        "AND CURRENT ROW)"
        for k in (5, 10)
    )
    whole = " AND ".join(f"{c} IS NOT NULL" for c in G.FEATURES)
    if not horizon:
        whole += " AND target IS NOT NULL"
    return f"""
vv AS (SELECT *, CASE WHEN count(return_1d) OVER w >= 10
                      THEN stddev_samp(return_1d) OVER w END AS volatility
       FROM r WINDOW w AS (PARTITION BY {B.SERIES} ORDER BY ts_utc
                           ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)),
ff AS (SELECT {B.SERIES}, ts_utc, return_1d, "close", volatility, {lags}, {vols}, {rolling},
              {target} AS target
       FROM vv WINDOW w AS (PARTITION BY {B.SERIES} ORDER BY ts_utc), {frames}),
f AS (SELECT * FROM ff WHERE {whole})"""


_COMPUTED = ("volatility", *(c for c in G.FEATURES if not c.startswith("ret_lag")))


def _features_out(digits: int) -> str:
    shown = ", ".join(f"round({c}, {digits}) AS {c}" for c in _COMPUTED)
    return f"SELECT * REPLACE ({shown}) FROM f"


@query(f"{CANDLE_RETURNS}, {_features_sql()} {_features_out(4)}")
def features(spark, sf):
    return B.rounded(G.features_from_bars(daily_bars(spark, sf), long_series=None), 4, *_COMPUTED)


@query(f"{CANDLE_RETURNS}, {_features_sql()} {_features_out(4)}")
def features_joined(spark, sf):
    """Volatility taken from its own table by a join."""
    made = R.returns(daily_bars(spark, sf), long_series=None)
    risk = R.volatility(made, long_series=None)
    return B.rounded(G.features(made, risk, long_series=None), 4, *_COMPUTED)


@query(f"{QUOTE_RETURNS}, {_features_sql(1)} {_features_out(2)}")
def features_forecast(spark, sf):
    """Features with the next return as their target."""
    return B.rounded(G.features_from_bars(quote_bars(spark, sf), horizon=1), 2, *_COMPUTED)


@query(f"{FEW_SERIES}, {_features_sql()} {_features_out(2)}")
def features_long_series(spark, sf):
    bars, limit = few_series(spark, sf)
    return B.rounded(G.features_from_bars(bars, long_series=limit), 2, *_COMPUTED)


@query(f"""{CANDLE_RETURNS}, {_features_sql()}
SELECT {B.SERIES}, CAST(count(*) AS INTEGER) AS samples, max(ts_utc) AS last_ts,
       round(avg(target), 5) AS mean_target, round(avg(vol_lag_2), 5) AS mean_vol_lag_2,
       round(covar_pop(ret_lag_1, target), 5) AS cov_lag_target,
       round(covar_pop(ret_mean_5, ret_std_10), 5) AS cov_mean_std,
       round(arg_max(ret_mean_10, ts_utc), 5) AS newest_mean_10
FROM f GROUP BY ALL""")
def feature_moments(spark, sf):
    rows = G.features_from_bars(daily_bars(spark, sf), long_series=None)
    keys = ["asset_type", "symbol", "interval", "currency"]
    at = {name: i for i, name in enumerate([*G.FEATURES, "target"])}

    def cov(a, b):
        return F.col("cov")[at[a] * len(at) + at[b]]

    return B.rounded(
        G.moments(rows, keys).select(
            *keys, "samples", "last_ts",
            F.col("mean")[at["target"]].alias("mean_target"),
            F.col("mean")[at["vol_lag_2"]].alias("mean_vol_lag_2"),
            cov("ret_lag_1", "target").alias("cov_lag_target"),
            cov("ret_mean_5", "ret_std_10").alias("cov_mean_std"),
            F.col("newest")[at["ret_mean_10"]].alias("newest_mean_10"),
        ),
        5, "mean_target", "mean_vol_lag_2", "cov_lag_target", "cov_mean_std", "newest_mean_10",
    )


HUGE_ALPHA = 1e12
MEAN_TAIL = f"""{_features_sql()},
m AS (SELECT {B.SERIES}, avg(target) AS p, max(ts_utc) AS last_ts,
             arg_max("close", ts_utc) AS last_close, CAST(count(*) AS INTEGER) AS samples
      FROM f GROUP BY ALL HAVING count(*) >= 20),
o AS (SELECT {B.SERIES}, round(p, 4) AS prediction_return,
             CASE WHEN p > 0.003 THEN 'buy' WHEN p < -0.003 THEN 'sell' ELSE 'hold' END AS action,
             strftime(last_ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS last_ts,
             last_close, 'lasso' AS model,
             CAST({HUGE_ALPHA} AS DOUBLE) AS alpha, samples FROM m)"""
_MEAN_MODEL = f"{QUOTE_RETURNS}, {MEAN_TAIL}"


def _mean_model(spark, sf):
    rows = G.features_from_bars(quote_bars(spark, sf))
    return B.rounded(G.predictions(rows, alpha=HUGE_ALPHA), 4, "prediction_return")


@query(f"{_MEAN_MODEL} SELECT * FROM o")
def l1_predict_large_alpha(spark, sf):
    """A penalty so large that every coefficient is zero: the mean is predicted."""
    return _mean_model(spark, sf)


@query()
def l1_predict(spark, sf):
    return G.predictions(G.features_from_bars(quote_bars(spark, sf)))


@query()
def l1_predict_candles(spark, sf):
    return G.predictions(G.features_from_bars(daily_bars(spark, sf), long_series=None))


@query()
def l1_forecast(spark, sf):
    """Next-row forecast instead of a fitted value."""
    return G.predictions(G.features_from_bars(quote_bars(spark, sf), horizon=1))


# --- the optimum, checked ----------------------------------------------------


def _fitted_sql(features: str, least: int = 20) -> str:
    return f"""{features},
m AS (SELECT {B.SERIES}, CAST(count(target) AS INTEGER) AS samples, max(ts_utc) AS last_ts,
             arg_max("close", ts_utc) AS last_close
      FROM f GROUP BY ALL HAVING count(target) >= {least})
SELECT *, true AS optimal FROM m"""


def _certified(feature_rows):
    """Every fit meets the conditions of the optimum to seven digits."""
    fits = G.l1_fit(feature_rows)
    shown = ("asset_type", "symbol", "interval", "currency", "samples", "last_ts", "last_close")
    return fits.select(*shown, (F.col("gap") <= 1e-7).alias("optimal"))


@query(f"{QUOTE_RETURNS}, {_fitted_sql(_features_sql())}")
def l1_optimum(spark, sf):
    return _certified(G.features_from_bars(quote_bars(spark, sf)))


@query(f"{CANDLE_RETURNS}, {_fitted_sql(_features_sql())}")
def l1_optimum_candles(spark, sf):
    return _certified(G.features_from_bars(daily_bars(spark, sf), long_series=None))


@query(f"{QUOTE_RETURNS}, {_fitted_sql(_features_sql(1))}")
def l1_optimum_forecast(spark, sf):
    return _certified(G.features_from_bars(quote_bars(spark, sf), horizon=1))


# With at most two coefficients the optimum has a closed form: for each choice of them
# and of their signs two linear equations, kept if the signs come out and no other
# feature's slope is beyond the penalty.
SPARSE_ALPHA = 20.0
_NAMES = list(G.FEATURES)
_SUMS = ", ".join(
    [f"avg({a}) AS m_{i}" for i, a in enumerate(_NAMES)]
    + [f"arg_max({a}, ts_utc) AS n_{i}" for i, a in enumerate(_NAMES)]
    + [f"covar_pop({a}, target) AS c_{i}" for i, a in enumerate(_NAMES)]
)
_GRAM = ", ".join(
    "[" + ", ".join(f"covar_pop({_NAMES[min(i, j)]}, {_NAMES[max(i, j)]})" for j in range(len(_NAMES))) + "]"
    for i in range(len(_NAMES))
)


def _each(letter: str) -> str:
    return "[" + ", ".join(f"{letter}_{i}" for i in range(len(_NAMES))) + "]"


_SPARSE = f"""{QUOTE_RETURNS}, {_features_sql()},
sums AS (SELECT {B.SERIES}, CAST(count(*) AS INTEGER) AS samples, avg(target) AS y, {_SUMS}, [{_GRAM}] AS g
         FROM f GROUP BY {B.SERIES} HAVING count(*) >= 20),
problem AS (SELECT {B.SERIES}, samples, y, {_each('m')} AS m, {_each('n')} AS n, {_each('c')} AS c, g FROM sums),
signs AS (SELECT unnest([-1, 1]) AS s),
none AS (SELECT problem.*, 0 AS used, 1 AS i, 1 AS j, 0.0 AS wi, 0.0 AS wj FROM problem),
two AS (SELECT problem.*, 2 AS used, i, j,
          (g[j][j] * (c[i] - {SPARSE_ALPHA} * a.s) - g[i][j] * (c[j] - {SPARSE_ALPHA} * b.s))
            / (g[i][i] * g[j][j] - g[i][j] * g[i][j]) AS wi,
          (g[i][i] * (c[j] - {SPARSE_ALPHA} * b.s) - g[i][j] * (c[i] - {SPARSE_ALPHA} * a.s))
            / (g[i][i] * g[j][j] - g[i][j] * g[i][j]) AS wj, a.s AS si, b.s AS sj
        FROM problem, range(1, 13) r(i), range(1, 13) q(j), signs a, signs b
        WHERE i < j AND g[i][i] * g[j][j] - g[i][j] * g[i][j] > 1e-9 * g[i][i] * g[j][j]),
tried AS (
  SELECT * FROM none
  UNION ALL SELECT * FROM (SELECT problem.*, 1 AS used, i, i AS j, (c[i] - {SPARSE_ALPHA} * s.s) / g[i][i] AS wi,
    0.0 AS wj FROM problem, range(1, 13) r(i), signs s WHERE g[i][i] > 0
      AND sign((c[i] - {SPARSE_ALPHA} * s.s) / g[i][i]) = s.s)
  UNION ALL SELECT * EXCLUDE (si, sj) FROM two WHERE sign(wi) = si AND sign(wj) = sj),
best AS (
  SELECT * FROM tried
  WHERE len(list_filter(range(1, 13), lambda k:
    (used = 0 OR (k <> i AND (used = 1 OR k <> j)))
    AND abs(c[k] - g[k][i] * wi - g[k][j] * wj) > {SPARSE_ALPHA})) = 0)
SELECT {B.SERIES}, samples, used, round(y + (n[i] - m[i]) * wi + (n[j] - m[j]) * wj, 4) AS prediction_return
FROM best"""


@query(_SPARSE)
def l1_predict_sparse(spark, sf):
    """The fits that have at most two coefficients, with their predictions."""
    fits = G.l1_fit(G.features_from_bars(quote_bars(spark, sf)), SPARSE_ALPHA)
    used = F.size(F.filter("coefficients", lambda w: w != 0))
    return B.rounded(fits.filter(used <= 2).select(
        "asset_type", "symbol", "interval", "currency", "samples", used.alias("used"), "prediction_return",
    ), 4, "prediction_return")


@query(f"{_MEAN_MODEL} SELECT * FROM o WHERE asset_type = 'event' AND symbol = '7'")
def predictions_lookup(spark, sf):
    return V.predictions_lookup(_mean_model(spark, sf), "event", "7")


@query(f"{_MEAN_MODEL} SELECT * FROM o ORDER BY {B.SERIES} LIMIT 5")
def first_predictions(spark, sf):
    return V.first_predictions(_mean_model(spark, sf))
