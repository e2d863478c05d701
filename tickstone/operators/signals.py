"""Trend signal, model features and the per-series L1 regression."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import action, iso_utc, l1
from .returns import MIN_OBSERVATIONS, WINDOW_ROWS, add_returns, rolling_volatility
from .series import LONG_SERIES_ROWS, along_series, split_long_series

# Executors receive the solver itself, so they need not have this package.
cloudpickle.register_pickle_by_value(l1)

# --- fixed values ----------------------------------------------------------
TREND_ROWS = 30
TREND_MIN_CLOSES = 5
TREND_BAND = 0.002
RETURN_LAGS = 5
VOLATILITY_LAGS = 3
ROLLING = (5, 10)
MODEL_ALPHA = 0.001
MODEL_BAND = 0.003
MODEL_MIN_SAMPLES = 20
MODEL_NAME = "lasso"
INSUFFICIENT = "insufficient-data"

FEATURES = (
    *(f"ret_lag_{i}" for i in range(1, RETURN_LAGS + 1)),
    *(f"vol_lag_{i}" for i in range(VOLATILITY_LAGS)),
    *(f"ret_{stat}_{k}" for k in ROLLING for stat in ("mean", "std")),
)


def trend_signal(
    returns: DataFrame,
    rows: int = TREND_ROWS,
    min_closes: int = TREND_MIN_CLOSES,
    band: float = TREND_BAND,
    keys: Sequence[str] | None = None,
) -> DataFrame:
    """buy / sell / hold for every series, from the slope of its newest closes.

    The slope is the least-squares line through the last ``rows`` closes
    against their position, relative to the last close.  A series with fewer
    than ``min_closes`` closes gets ``insufficient-data`` and null numbers.
    """
    keys = list(keys or S.series_keys(returns))
    by_series = Window.partitionBy(*keys).orderBy(F.col("ts_utc").desc())
    newest = (
        returns.select(*keys, "ts_utc", "close")
        .withColumn("_back", F.row_number().over(by_series))
        .filter(F.col("_back") <= rows)
    )
    # Position counts forward in time, so it is minus the rank up to a shift
    # that does not affect the slope.
    fits = newest.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"),
        F.regr_slope("close", -F.col("_back")).alias("_slope"),
        F.min_by("close", "_back").alias("_last"),
    )
    enough = F.col("_n") >= min_closes
    relative = F.when(F.col("_last") == 0, 0.0).otherwise(F.try_divide("_slope", "_last"))
    return fits.select(
        *keys,
        F.when(enough, action(relative, band)).otherwise(INSUFFICIENT).alias("action"),
        F.when(enough, F.col("_slope")).alias("slope"),
        F.when(enough, relative).alias("rel_slope"),
        F.when(enough, F.col("_last")).alias("last_close"),
    )


def _full_window(value: Column, w, rows: int) -> Column:
    """``value`` where the window holds ``rows`` returns, else null."""
    return F.when(F.count("return_1d").over(w) == rows, value)


def _feature_columns(by: Sequence[str]) -> dict[str, Column]:
    series = Window.partitionBy(*by).orderBy("ts_utc")
    out = {f"ret_lag_{i}": F.lag("return_1d", i).over(series) for i in range(1, RETURN_LAGS + 1)}
    for i in range(VOLATILITY_LAGS):
        out[f"vol_lag_{i}"] = F.lag("volatility", i).over(series) if i else F.col("volatility")
    for k in ROLLING:
        w = series.rowsBetween(1 - k, 0)
        out[f"ret_mean_{k}"] = _full_window(F.avg("return_1d").over(w), w, k)
        out[f"ret_std_{k}"] = _full_window(F.stddev_samp("return_1d").over(w), w, k)
    return out


def _add_features(
    df: DataFrame, keys: Sequence[str], with_volatility: bool, horizon: int
) -> DataFrame:
    """Features and target; rows with an incomplete feature vector are dropped,
    as are rows without a target unless they are what a forecast starts from."""

    def featured(part: DataFrame, by: list[str]) -> DataFrame:
        if with_volatility:
            vol = rolling_volatility(by, WINDOW_ROWS, MIN_OBSERVATIONS)
            part = part.withColumn("volatility", vol)
        return part.withColumns(_feature_columns(by)).withColumn("target", F.col("return_1d"))

    reach = max(RETURN_LAGS, VOLATILITY_LAGS - 1, max(ROLLING) - 1)
    if with_volatility:
        reach = max(reach, WINDOW_ROWS - 1 + VOLATILITY_LAGS - 1)
    df = along_series(df, keys, reach, featured)
    if horizon == 0:
        return df.dropna(subset=[*FEATURES, "target"])

    def ahead(part: DataFrame, by: list[str]) -> DataFrame:
        w = Window.partitionBy(*by).orderBy(F.col("ts_utc").desc())
        return part.withColumn("target", F.lag("return_1d", horizon).over(w))

    return along_series(df, keys, horizon, ahead, ascending=False).dropna(subset=list(FEATURES))


def features(
    returns: DataFrame,
    volatility: DataFrame | None = None,
    horizon: int = 0,
    keys: Sequence[str] | None = None,
    long_series: int | None = LONG_SERIES_ROWS,
    store: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Lags, rolling statistics and target per return; incomplete rows dropped.

    With a ``volatility`` table its values are joined on series and time;
    without one they are computed in the same windows, saving the join.
    ``horizon`` is how many rows ahead the target return lies; at 0 it is the
    return of the row itself, beyond that the newest rows have a null target.
    ``store`` keeps the joined rows, which are read several times where series are long.
    """
    keys = list(keys or S.series_keys(returns))
    keep = [*keys, "ts_utc", "return_1d", "close"]
    base = returns.select(*keep)
    if volatility is not None:
        at = [*keys, "ts_utc"]
        known = volatility.select(F.struct(*at).alias("_at"), "volatility")
        base = base.withColumn("_at", F.struct(*at)).join(known, "_at", "left").drop("_at")
        base = base if store is None else store(base)
    base = split_long_series(base, keys, limit=long_series)
    full = _add_features(base, keys, volatility is None, horizon)
    return full.select(*keep, "volatility", *FEATURES, "target")


def features_from_bars(
    bars: DataFrame,
    horizon: int = 0,
    keys: Sequence[str] | None = None,
    long_series: int | None = LONG_SERIES_ROWS,
) -> DataFrame:
    """``features(returns(bars))`` with one exchange for all windows."""
    keys = list(keys or S.series_keys(bars))
    bars = split_long_series(bars, keys, limit=long_series)
    full = _add_features(add_returns(bars, keys), keys, True, horizon)
    keep = [*keys, "ts_utc", "return_1d", "close", "volatility"]
    return full.select(*keep, *FEATURES, "target")


# --- L1 regression ---------------------------------------------------------


def moments(feature_rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per series: sample count, newest feature row, means and covariances of
    features and target.  That is all a fit needs, in one fixed-size row.

    Each row is spread over one row per variable first.  That keeps every
    aggregate narrow enough for generated code (a hundred covariances side by
    side are not), and on rows already grouped by series needs no exchange.
    """
    names = [*FEATURES, "target"]
    variables = F.array(
        *(F.struct(F.lit(i).alias("_i"), F.col(c).alias("_x")) for i, c in enumerate(names))
    )
    tall = feature_rows.select(*keys, "ts_utc", "close", *names, F.inline(variables))
    # Rows that wait for their target lend only their features to the forecast.
    known = F.when(F.col("target").isNotNull(), F.col("_x"))
    per_variable = tall.groupBy(*keys, "_i").agg(
        F.count(known).alias("n"),
        F.max("ts_utc").alias("ts"),
        F.max_by("close", "ts_utc").alias("close"),
        F.max_by("_x", "ts_utc").alias("newest"),
        F.avg(known).alias("mean"),
        *(F.covar_pop(known, c).alias(f"c_{c}") for c in names),
    )
    row = F.struct(
        "_i", "n", "ts", "close", "newest", "mean",
        F.array(*(f"c_{c}" for c in names)).alias("cov"),
    )
    rows = F.col("_rows")
    return (
        per_variable.groupBy(*keys)
        .agg(F.sort_array(F.collect_list(row)).alias("_rows"))  # one element per variable
        .select(
            *keys,
            rows[0]["n"].cast("int").alias("samples"),
            rows[0]["ts"].alias("last_ts"),
            rows[0]["close"].alias("last_close"),
            F.transform(rows, lambda r: r["newest"]).alias("newest"),
            F.transform(rows, lambda r: r["mean"]).alias("mean"),
            F.flatten(F.transform(rows, lambda r: r["cov"])).alias("cov"),
        )
    )


def l1_fit(
    feature_rows: DataFrame,
    alpha: float = MODEL_ALPHA,
    min_samples: int = MODEL_MIN_SAMPLES,
    keys: Sequence[str] | None = None,
) -> DataFrame:
    """One L1 regression per series with its value for the newest row.

    Minimises ``|y - Xw - b|^2 / 2n + alpha*|w|_1`` with intercept and without
    scaling.  Only the per-series moments reach Python.  ``gap`` says how far the fit is
    from meeting the conditions of the optimum, relative to the series' covariances: about
    1e-9 and less where the solver ended by itself.
    """
    keys = list(keys or S.series_keys(feature_rows))
    stats = moments(feature_rows, keys).filter(F.col("samples") >= min_samples)
    kinds = {f.name: f.dataType.simpleString() for f in stats.schema.fields}
    out = [*keys, "last_ts", "last_close", "samples"]
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in out)
    schema += ", prediction_return double, coefficients array<double>, gap double"
    # The rows are few bytes and much work: spread them by count, not by size.
    spark = stats.sparkSession
    tasks = max(
        int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism
    )
    stats = stats.repartition(tasks, *keys)
    fit = l1.batch_fitter(keys, alpha)
    return stats.mapInPandas(fit, schema)


def predictions(
    feature_rows: DataFrame,
    alpha: float = MODEL_ALPHA,
    min_samples: int = MODEL_MIN_SAMPLES,
    band: float = MODEL_BAND,
    keys: Sequence[str] | None = None,
) -> DataFrame:
    """Predicted return and buy / sell / hold per series.

    With features of ``horizon=0`` the target is the row's own return, so this
    is a fitted value of the newest row; with a longer horizon it is a forecast.
    """
    keys = list(keys or S.series_keys(feature_rows))
    fitted = l1_fit(feature_rows, alpha, min_samples, keys)
    return fitted.select(
        *keys,
        "prediction_return",
        action(F.col("prediction_return"), band).alias("action"),
        iso_utc(fitted, "last_ts").alias("last_ts"),
        "last_close",
        F.lit(MODEL_NAME).alias("model"),
        F.lit(float(alpha)).alias("alpha"),
        "samples",
    )
