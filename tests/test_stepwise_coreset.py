"""Rolling-origin evaluation against refits; coreset sweeps against full fits."""

import datetime as dt

import numpy as np
import pytest

from trafficlens.operators import coreset as CS
from trafficlens.operators import models as M
from trafficlens.operators import stepwise as SW

START = dt.datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(4)
    x = rng.normal(0, 1, (240, 2)) + [0, 1000]
    y = x @ [2.0, -1.0] + rng.normal(0, 0.5, 240)
    out = [[START + dt.timedelta(seconds=i), float(a), float(b), float(v)] for i, ((a, b), v) in enumerate(zip(x, y))]
    out[150][1] = None  # a feature is missing
    out[160][3] = None  # a label is missing
    out += [[None, 1.0, 1.0, 1.0]]
    return out


def table(spark, rows):
    return spark.createDataFrame([tuple(r) for r in rows], "bucket timestamp_ntz, a double, b double, label double").repartition(5)


@pytest.mark.parametrize("steps", [1, 7, 4096])
@pytest.mark.parametrize("reg, intercept", [(0.0, True), (0.3, False)])
def test_each_step_equals_a_refit(spark, rows, steps, reg, intercept):
    from trafficlens.operators.moments import Moments, ridge

    cut = START + dt.timedelta(seconds=100)
    got = SW.rolling_origin(table(spark, rows), ["a", "b"], cutoff=str(cut), reg=reg, intercept=intercept, steps=steps).orderBy("bucket").collect()
    assert [r.bucket for r in got] == [r[0] for r in rows[100:240]]
    for i, r in enumerate(got, 100):
        before = np.array([q[1:] for q in rows[:i] if None not in q[1:]])
        m = Moments(len(before), before.mean(axis=0), np.cov(before.T, bias=True) * len(before))
        w, b = ridge(m, reg, intercept)
        assert r.n_train == len(before) and np.allclose(r.coefficients, w, rtol=1e-6)
        if i == 150:
            assert r.prediction is None
        else:
            assert r.prediction == pytest.approx(rows[i][1] * w[0] + rows[i][2] * w[1] + b, abs=1e-5)
        assert r.label == rows[i][3]


def test_interval_cut_and_empty_sides(spark, rows):
    df = table(spark, rows)
    assert SW.rolling_origin(df, ["a"], last="10 seconds").count() == 11
    from_start = SW.rolling_origin(df, ["a"], cutoff="2023-01-01 00:00:00").orderBy("bucket").collect()
    assert len(from_start) == 240 and from_start[0].prediction is None and from_start[0].n_train == 0 and from_start[1].prediction is not None
    assert SW.rolling_origin(df, ["a"], cutoff="2030-01-01 00:00:00").count() == 0
    with pytest.raises(ValueError):
        SW.rolling_origin(df, ["a"])


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(5)
    centres = rng.uniform(-50, 50, (6, 3))
    x = centres[rng.choice(6, 40_000, p=[0.5, 0.2, 0.15, 0.1, 0.04, 0.01])] + rng.normal(0, 1, (40_000, 3))
    return spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "id long, x double, y double, z double").repartition(8).cache()


XYZ = ["x", "y", "z"]


def test_coreset_is_bounded_and_sums_to_the_table(points):
    few = CS.kmeans_coreset(points, XYZ, "id", 2000)
    total = few.selectExpr("count(*) AS n", "sum(weight) AS w", "sum(weight * x) / sum(weight) AS mx").first()
    assert abs(total.n - 2000) < 200 and abs(total.w - 40_000) < 2000
    assert total.mx == pytest.approx(points.selectExpr("avg(x)").first()[0], abs=1.5)
    assert CS.kmeans_coreset(points, XYZ, "id", 10**7).selectExpr("count(*)", "max(weight)").first()[:] == (40_000, 1.0)
    again = CS.kmeans_coreset(points.repartition(3), XYZ, "id", 2000)  # the same rows on any partitioning
    assert few.select("id").exceptAll(again.select("id")).count() == 0


def test_sweep_costs_are_within_five_per_cent_of_full_fits(points):
    ks = [2, 4, 6, 8]
    sweep = CS.coreset_sweep(points, XYZ, "id", ks, size=3000)
    full = {r.k: r.wssse for r in M.kmeans_sweep(M.assemble(points, XYZ), ks).collect()}
    assert all(sweep.costs[k] <= 1.05 * full[k] for k in ks), (sweep.costs, full)
    assert sorted((r.k, r.wssse) for r in sweep.table(points.sparkSession).collect()) == sorted(sweep.costs.items())


def test_cost_of_all_sets_of_centres(points):
    rng = np.random.default_rng(1)
    x = np.array(points.select(XYZ).collect())
    centres = {k: rng.uniform(-50, 50, (k, 3)) for k in (1, 5)}
    want = {k: ((x[:, None] - c[None]) ** 2).sum(axis=2).min(axis=1).sum() for k, c in centres.items()}
    assert CS.cost_of_all(points, XYZ, centres) == pytest.approx(want)


def test_knee():
    assert CS.Sweep({}, {2: 100.0, 3: 40.0, 4: 15.0, 5: 12.0, 6: 10.0}).knee() == 4
    assert CS.Sweep({}, {2: 5.0, 3: 5.0, 4: 5.0}).knee() == 2 and CS.Sweep({}, {7: 1.0}).knee() == 7


def test_rows_without_values_and_equal_rows(spark):
    df = spark.createDataFrame([(i, 1.0, None if i == 0 else 2.0, 3.0) for i in range(50)], "id long, x double, y double, z double")
    few = CS.kmeans_coreset(df, XYZ, "id", 20)
    assert 5 < few.count() < 40
    sweep = CS.coreset_sweep(df, XYZ, "id", [1, 3], size=20)
    assert max(sweep.costs.values()) < 1e-20
    assert CS.kmeans_coreset(df.limit(0), XYZ, "id").count() == 0
    with pytest.raises(ValueError):
        CS.coreset_sweep(df.limit(0), XYZ, "id", [2])
