"""Trend signal, features, and the L1 solver against other solvers."""

import random
from datetime import timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F
from test_returns import START, bars, series

from tickstone.functions import l1
from tickstone.functions.l1 import solve_l1
from tickstone.operators import returns as R
from tickstone.operators import serving as V
from tickstone.operators import signals as G

KEYS = ["asset_type", "symbol", "interval", "currency"]


def walk(seed, n, spread=0.05):
    rng = random.Random(seed)
    out = [100.0]
    while len(out) < n:
        out.append(out[-1] * (1 + rng.gauss(0, spread)))
    return out


def trend(spark, closes):
    return G.trend_signal(R.returns(bars(spark, series(closes)))).first()


def test_trend_matches_a_line_fit(spark):
    closes = walk(3, 80)
    slope = np.polyfit(np.arange(30), closes[-30:], 1)[0]
    row = trend(spark, closes)
    assert row.slope == pytest.approx(slope)
    assert row.rel_slope == pytest.approx(slope / closes[-1])
    assert row.last_close == closes[-1]


@pytest.mark.parametrize("step, action", [(0.01, "buy"), (-0.01, "sell"), (0.0005, "hold")])
def test_trend_actions(spark, step, action):
    assert trend(spark, [100 * (1 + step) ** i for i in range(20)]).action == action


def test_trend_needs_five_closes_hence_six_bars(spark):
    five = trend(spark, [1.0, 2.0, 3.0, 4.0, 5.0])
    assert (five.action, five.slope, five.last_close) == ("insufficient-data", None, None)
    assert trend(spark, [1.0, 2.0, 3.0, 4.0, 5.0, 6.0]).action == "buy"


def test_trend_with_zero_last_close_holds(spark):
    row = trend(spark, [5.0, 4.0, 3.0, 2.0, 1.0, 0.0])
    assert (row.action, row.rel_slope) == ("hold", 0.0)


def test_recommendation_for_unknown_symbol(spark):
    made = R.returns(bars(spark, series(walk(1, 40), "A")))
    assert V.recommendation(made, "stock", "A").first().action != "insufficient-data"
    rows = V.recommendation(made, "stock", "nope").collect()
    assert [(r.symbol, r.action, r.slope) for r in rows] == [("nope", "insufficient-data", None)]


def pandas_features(closes):
    r = pd.Series(closes).pct_change().iloc[1:].reset_index(drop=True)
    vol = r.rolling(30, min_periods=10).std()
    f = pd.DataFrame({f"ret_lag_{i}": r.shift(i) for i in range(1, 6)})
    for i in range(3):
        f[f"vol_lag_{i}"] = vol.shift(i)
    for k in (5, 10):
        f[f"ret_mean_{k}"] = r.rolling(k).mean()
        f[f"ret_std_{k}"] = r.rolling(k).std()
    f["target"] = r
    return f.dropna()[[*G.FEATURES, "target"]]


@pytest.mark.parametrize("limit", [None, 25])
def test_features_match_pandas(spark, limit):
    closes = walk(5, 120)
    df = G.features_from_bars(bars(spark, series(closes)), long_series=limit)
    mine = df.orderBy("ts_utc").select(*G.FEATURES, "target").toPandas()
    np.testing.assert_allclose(mine, pandas_features(closes), rtol=1e-9, atol=1e-12)


def test_joined_features_equal_inline_ones(spark):
    df = bars(spark, series(walk(5, 60), "A"), series(walk(6, 60), "B", currency=None))
    made = R.returns(df)
    joined = G.features(made, R.volatility(made))
    inline = G.features_from_bars(df).select(*joined.columns)
    assert sorted(map(tuple, joined.collect()), key=str) == sorted(
        map(tuple, inline.collect()), key=str
    )
    assert joined.count() == 2 * (60 - 12)


def test_fewest_bars_for_a_prediction(spark):
    """11 rows are lost to the volatility lags, so 20 samples need 32 bars."""
    df = bars(spark, series(walk(1, 31), "few"), series(walk(2, 32), "enough"))
    rows = G.predictions(G.features_from_bars(df)).collect()
    assert [(r.symbol, r.samples) for r in rows] == [("enough", 20)]


def test_small_returns_predict_their_mean(spark):
    closes = walk(9, 80, 0.01)
    row = G.predictions(G.features_from_bars(bars(spark, series(closes)))).first()
    assert row.prediction_return == pytest.approx(pandas_features(closes)["target"].mean())
    last = START + timedelta(days=79)
    assert (row.last_ts, row.model) == (f"{last:%Y-%m-%dT%H:%M:%S}+00:00", "lasso")


@pytest.mark.parametrize("alpha", [1e-6, 1e-4])
@pytest.mark.parametrize("horizon", [0, 1])
def test_fit_equals_another_solver(spark, alpha, horizon):
    df = G.features_from_bars(bars(spark, series(walk(4, 150))), horizon=horizon)
    mine = G.l1_fit(df, alpha).first()
    vectors = VectorAssembler(inputCols=list(G.FEATURES), outputCol="x")
    train = vectors.transform(df.filter("target is not null"))
    other = LinearRegression(
        featuresCol="x", labelCol="target", elasticNetParam=1.0, standardization=False,
        maxIter=100000, tol=1e-14,
        regParam=alpha,
    ).fit(train)
    w, b = np.array(other.coefficients), other.intercept
    newest = np.array(df.orderBy(F.col("ts_utc").desc()).select(*G.FEATURES).first())
    assert mine.prediction_return == pytest.approx(newest @ w + b, abs=2e-6)

    x, y = np.array(train.select(*G.FEATURES).collect()), np.array(train.select("target").collect())[:, 0]

    def cost(at):
        left = (y - y.mean()) - (x - x.mean(0)) @ at
        return left @ left / (2 * len(y)) + alpha * np.abs(at).sum()

    assert cost(np.array(mine.coefficients)) <= cost(w) + 1e-12


def test_solver_meets_the_optimality_conditions():
    rng = np.random.default_rng(0)
    problems, p = 200, 12
    x = rng.normal(size=(problems, 40, p)) * 10.0 ** rng.uniform(-3, 2, size=(problems, 1, p))
    x[:50, :, 3] = x[:50, :, 1] + x[:50, :, 2]  # dependent features
    x[50:60, :, 4] = 1.0  # a constant one
    y = np.einsum("bnp,p->bn", x, rng.normal(size=p)) + rng.normal(size=(problems, 40))
    x, y = x - x.mean(1, keepdims=True), y - y.mean(1, keepdims=True)
    gram = np.einsum("bni,bnj->bij", x, x) / 40
    cov = np.einsum("bni,bn->bi", x, y) / 40
    for alpha in (1e-3, 0.1, 5.0):
        w = solve_l1(gram, cov, alpha)
        slope = cov - np.einsum("bij,bj->bi", gram, w)
        scale = np.abs(cov).max(1, keepdims=True) + alpha
        assert (np.abs(slope) - alpha <= 1e-7 * scale).all()
        assert (np.abs(slope - alpha * np.sign(w))[w != 0] <= (1e-7 * scale * (w != 0))[w != 0]).all()


def test_a_solve_that_ran_out_of_steps_shows(monkeypatch):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(400, 6)) @ rng.normal(size=(6, 6)) + 5 * rng.normal(size=(400, 1))
    x[:, 5] = x[:, 4] + 1e-3 * rng.normal(size=400)
    y = x @ rng.normal(size=6) + rng.normal(size=400)
    x, y = x - x.mean(0), y - y.mean()
    gram, cov = (x.T @ x / 400)[None], (x.T @ y / 400)[None]
    assert l1.subgradient_gap(gram, cov, l1.solve_l1(gram, cov, 0.01), 0.01)[0] < 1e-8
    zeros = np.zeros_like(cov)
    expected = (np.abs(cov).max() - 0.01) / (np.abs(cov).max() + 0.01)
    assert l1.subgradient_gap(gram, cov, zeros, 0.01)[0] == pytest.approx(expected)
    monkeypatch.setattr(l1, "_active_set", lambda g, c, penalty, w: w)
    monkeypatch.setattr(l1, "_SWEEPS", 1)
    assert l1.subgradient_gap(gram, cov, l1.solve_l1(gram, cov, 0.01), 0.01)[0] > 1e-4
