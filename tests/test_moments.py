"""One-pass linear models against numpy and Spark ML."""

import numpy as np
import pytest

from tests.conftest import SF01
from trafficlens.operators import load as L
from trafficlens.operators import models as M
from trafficlens.operators import moments as MO
from trafficlens.plans import queries as Q


def frame(spark, x, y, fold=None):
    rows = [(*map(float, r), float(v), int(f)) for r, v, f in zip(x, y, fold if fold is not None else np.zeros(len(y)))]
    names = ", ".join(f"x{i} double" for i in range(x.shape[1]))
    return spark.createDataFrame(rows, f"{names}, label double, fold int").repartition(5)


@pytest.fixture(scope="module")
def noisy():
    rng = np.random.default_rng(1)
    x = rng.normal(0, 1, (400, 3)) * [1, 100, 0.01] + [5, 1e6, 0]  # a large mean that raw products would lose
    return x, x @ [2, -0.03, 7] + rng.normal(0, 1, 400), rng.integers(0, 5, 400)


def test_moments_merge_to_those_of_all_rows(spark, noisy):
    x, y, fold = noisy
    parts = MO.collect_moments(MO.fold_moments(frame(spark, x, y, fold), ["x0", "x1", "x2"], group="fold"))
    m = sum((parts[k] for k in sorted(parts)), MO.Moments.none(4))
    data = np.column_stack([x, y])
    assert m.n == 400 and np.allclose(m.mean, data.mean(axis=0), rtol=1e-14)
    assert np.allclose(m.comoment, np.cov(data.T, bias=True) * 400, rtol=1e-10)


def test_fit_equals_numpy(spark, noisy):
    x, y, _ = noisy
    fit = MO.fit_linear_once(frame(spark, x, y), ["x0", "x1", "x2"])
    design = np.column_stack([x - x.mean(axis=0), np.ones(len(y))])
    want = np.linalg.lstsq(design, y, rcond=None)[0]
    assert np.allclose(fit.coefficients, want[:3], rtol=1e-8)
    predicted = [r.prediction for r in fit.predict(frame(spark, x, y)).select("prediction", "x1").orderBy("x1").collect()]
    assert np.allclose(predicted, (design @ want)[np.argsort(x[:, 1])], atol=1e-6)
    assert fit.training["mse"] == pytest.approx(np.mean((y - design @ want) ** 2), rel=1e-8)


@pytest.mark.parametrize("reg", [0.0, 0.01, 3.0])
@pytest.mark.parametrize("intercept", [True, False])
def test_penalised_fit_equals_spark(spark, reg, intercept):
    from pyspark.ml.regression import LinearRegression

    data = Q._model_frame(spark, SF01)
    theirs = LinearRegression(regParam=reg, fitIntercept=intercept).fit(data)
    ours = MO.fit_linear_once(data, L.FEATURE_COLUMNS, reg=reg, intercept=intercept)
    assert np.allclose(ours.coefficients, np.array(theirs.coefficients), rtol=1e-8)
    assert ours.intercept == pytest.approx(theirs.intercept, abs=1e-8)
    assert ours.training["rmse"] == pytest.approx(theirs.summary.rootMeanSquaredError, rel=1e-10)
    assert ours.training["r2"] == pytest.approx(theirs.summary.r2, abs=1e-8) or not intercept


def test_cross_validation_equals_spark(spark):
    train = Q._model_frame(spark, SF01).where("split = 'train'")
    theirs = M.fit_linear_cv(train, fold_col="fold")
    ours = MO.cross_validate_linear(train, L.FEATURE_COLUMNS)
    means = {}
    for reg, intercept, _, _, rmse in ours.grid:
        means.setdefault((reg, intercept), []).append(rmse)
    assert np.allclose([np.mean(v) for v in means.values()], theirs.avgMetrics, rtol=1e-9)
    best = theirs.bestModel
    assert (ours.best.reg, ours.best.fit_intercept) == (best.getRegParam(), best.getFitIntercept())
    assert np.allclose(ours.best.coefficients, np.array(best.coefficients), rtol=1e-6)


def test_cross_validation_reads_the_rows_once(spark, noisy):
    x, y, fold = noisy
    tracker, sc = spark.sparkContext.statusTracker(), spark.sparkContext
    df = frame(spark, x, y, fold)
    sc.setJobGroup("cv", "cv")
    try:
        MO.cross_validate_linear(df, ["x0", "x1", "x2"], reg=(0.0, 0.1, 1.0, 10.0))
        stages = {s for j in tracker.getJobIdsForGroup("cv") for s in tracker.getJobInfo(j).stageIds}
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    plan = MO.fold_moments(df, ["x0"], group="fold")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(group") == 1 and len(stages) < 12  # not 24 fits


def test_rows_without_values_and_degenerate_tables(spark):
    x = np.array([[1.0, 7, 2], [2, 7, 4], [3, 7, 6], [4, 7, 8]])
    y = np.array([3.0, 5, 7, 9])
    df = frame(spark, x, y, [0, 0, 1, 1])
    # a constant feature gets nothing; of equal directions the shortest solution
    fit = MO.fit_linear_once(df, ["x0", "x1", "x2"])
    assert fit.coefficients[1] == 0 and fit.training["rmse"] < 1e-8
    assert np.allclose(np.array(fit.coefficients[::2]) * x.std(axis=0)[::2], [np.sqrt(5) / 2] * 2)
    nulls = df.unionByName(spark.createDataFrame([(None, 1.0, 1.0, 100.0, 0), (1.0, 1.0, 1.0, None, 0)], df.schema))
    assert MO.fit_linear_once(nulls, ["x0"]).n == 4
    unknown = df.unionByName(spark.createDataFrame([(9.0, 9.0, 9.0, 90.0, None)], df.schema))
    assert MO.cross_validate_linear(unknown, ["x0"], reg=[0.0]).best.coefficients == pytest.approx((2.0,))
    flat = frame(spark, x, np.full(4, 6.0))
    assert MO.fit_linear_once(flat, ["x0"]).coefficients == (0.0,) and MO.fit_linear_once(flat, ["x0"]).intercept == 6
    with pytest.raises(ValueError):
        MO.fit_linear_once(df.limit(0), ["x0"])
    with pytest.raises(ValueError):
        MO.cross_validate_linear(df.where("fold = 0"), ["x0"])
