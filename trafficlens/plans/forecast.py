"""Registered queries on load forecasting: one-pass linear models, lags and
autocorrelation across ranges, autoregressive models, stepwise evaluation."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import load as L
from ..operators import moments as MO
from ..operators import stats as ST
from ..operators import stepwise as SW
from ..operators import timeseries as TS
from ..functions.columns import col
from .queries import LAGS, Query, _features, _labelled, _model_frame, rounded


def q_linear_fit_once(spark, sf):
    """The eight-feature fit from one aggregate of moments (M4)."""
    train = _model_frame(spark, sf).where(col("split") == "train")
    return rounded(MO.fit_linear_once(train, L.FEATURE_COLUMNS).table(spark))


def q_linear_cv_grid(spark, sf):
    """Mean held-out RMSE of each setting, all fits from one aggregate (M6)."""
    train = _model_frame(spark, sf).where(col("split") == "train")
    return rounded(MO.cross_validate_linear(train, L.FEATURE_COLUMNS).averages(spark))


def q_linear_cv_folds(spark, sf):
    """The held-out error of every fit of the grid, and its rows."""
    train = _model_frame(spark, sf).where(col("split") == "train")
    return rounded(MO.cross_validate_linear(train, L.FEATURE_COLUMNS).table(spark))


ACF_LAGS = 12
ARMA = {"p": 2, "d": 1, "q": 1, "long": 6}
HALO_BLOCK = 100  # rows of a block, far fewer than the series has


def _series(spark, sf):
    """Distinct URLs per hour as one sequence."""
    return TS.ordered(_features(spark, sf).select("bucket", "ct_url"), value="ct_url")


def q_lags_across_days(spark, sf):
    """Lags and next value of the whole series (W4, W5 across day borders)."""
    series = _series(spark, sf)
    lagged = TS.lags_across(series, n=LAGS, block=HALO_BLOCK)
    return TS.next_across(lagged, block=HALO_BLOCK)


def q_moving_average_across_days(spark, sf):
    return rounded(TS.moving_average_across(_series(spark, sf), n=LAGS, block=HALO_BLOCK).select("bucket", "autoregressive_value"))


def q_autocorrelation(spark, sf):
    """ACF and PACF of the load (M10 for a dozen lags of the whole series)."""
    return rounded(TS.autocorrelation(_series(spark, sf), max_lag=ACF_LAGS, block=HALO_BLOCK))


def q_ar_forecast(spark, sf):
    """One-step forecasts of an autoregression on the six lags."""
    series = _series(spark, sf)
    model = TS.fit_ar(series, p=LAGS, block=HALO_BLOCK)
    return rounded(TS.forecast(series, model, block=HALO_BLOCK).select("bucket", "prediction", "residual"))


def q_arima_forecast(spark, sf):
    """One-step forecasts and conditional residuals of an ARIMA(2, 1, 1)."""
    series = _series(spark, sf)
    model = TS.fit_arima(series, **ARMA, block=HALO_BLOCK)
    return rounded(TS.forecast(series, model, block=HALO_BLOCK).select("bucket", "prediction", "residual"))


def q_forecast_metrics(spark, sf):
    """Errors of the forecasts and of the moving average over the same hours,
    those after the sixth; the models are fitted on the first 80 per cent of
    the hours and judged on the others."""
    series = _series(spark, sf)
    first = series.where(col("position") < F.lit(0.8) * series.select(F.count("*")).scalar())
    judged = []
    for name, model in (("ar", TS.fit_ar(first, p=LAGS)), ("arima", TS.fit_arima(first, **ARMA))):
        judged.append((name, TS.forecast(series, model), "prediction"))
    judged.append(("moving_average", TS.moving_average_across(series, n=LAGS), "autoregressive_value"))
    out = None
    for name, scored, prediction in judged:
        late = scored.where(col("position") >= F.lit(0.8) * series.select(F.count("*")).scalar())
        late = late.withColumn("ct_url", col("ct_url").cast("double"))
        row = ST.regression_metrics(late, "ct_url", prediction).select(F.lit(name).alias("model"), "n", "mse", "rmse", "mae")
        out = row if out is None else out.unionByName(row)
    return rounded(out)


HOLDOUT = "5 days"


def q_stepwise_holdout(spark, sf):
    """Each hour of the last days predicted from one feature by a line through all hours before it."""
    out = SW.rolling_origin(_labelled(spark, sf), ["ct_url"], last=HOLDOUT, steps=50)
    return rounded(out.select("bucket", "label", "prediction", "n_train"))


def q_stepwise_holdout_features(spark, sf):
    """The same from the eight load features."""
    filled = L.fill_zero(_labelled(spark, sf), L.FEATURE_COLUMNS)
    return rounded(SW.rolling_origin(filled, L.FEATURE_COLUMNS, last=HOLDOUT, steps=50).select("bucket", "label", "prediction", "n_train"))


def q_stepwise_metrics(spark, sf):
    filled = L.fill_zero(_labelled(spark, sf), L.FEATURE_COLUMNS)
    return rounded(ST.regression_metrics(SW.rolling_origin(filled, L.FEATURE_COLUMNS, last=HOLDOUT)))


QUERIES: dict[str, Query] = {
    "linear_fit_once": q_linear_fit_once,
    "linear_cv_grid": q_linear_cv_grid,
    "linear_cv_folds": q_linear_cv_folds,
    "stepwise_holdout": q_stepwise_holdout,
    "stepwise_holdout_features": q_stepwise_holdout_features,
    "stepwise_metrics": q_stepwise_metrics,
    "lags_across_days": q_lags_across_days,
    "moving_average_across_days": q_moving_average_across_days,
    "autocorrelation": q_autocorrelation,
    "ar_forecast": q_ar_forecast,
    "arima_forecast": q_arima_forecast,
    "forecast_metrics": q_forecast_metrics,
}
