
import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF01
from trafficlens.operators import load as L
from trafficlens.operators import models as M
from trafficlens.operators import moments as MO
from trafficlens.operators import stats as ST
from trafficlens.plans import queries as Q


@pytest.fixture(scope="module")
def labelled(spark):
    return M.assemble(Q._labelled(spark, SF01), L.FEATURE_COLUMNS).cache()


def test_linear_residuals_orthogonal_to_features(labelled):
    model = M.fit_linear(labelled)
    rows = M.score(model, labelled).select("features", "label", "prediction").collect()
    X = np.array([r.features.toArray() for r in rows])
    res = np.array([r.label - r.prediction for r in rows])
    assert abs(res.sum()) < 1e-6 * len(res) * max(1.0, np.abs(res).max())
    scale = np.abs(X).sum(axis=0) * np.abs(res).max() + 1e-12
    assert np.all(np.abs(X.T @ res) / scale < 1e-6)


def test_linear_matches_numpy_least_squares(labelled):
    model = M.fit_linear(labelled)
    rows = labelled.select("features", "label").collect()
    X = np.array([r.features.toArray() for r in rows])
    y = np.array([r.label for r in rows])
    A = np.hstack([X, np.ones((len(X), 1))])
    coef = np.linalg.lstsq(A, y, rcond=None)[0]
    pred_np = A @ coef
    pred_sp = np.array([r.prediction for r in M.score(model, labelled).select("prediction").collect()])
    assert np.allclose(pred_np, pred_sp, atol=1e-6 * max(1.0, np.abs(y).max()))


def test_tree_prediction_is_leaf_mean(labelled):
    model = M.fit_tree(labelled, maxDepth=3)
    scored = M.score(model, labelled)
    per_leaf = scored.groupBy("prediction").agg(F.avg("label").alias("m")).collect()
    for r in per_leaf:
        assert r.prediction == pytest.approx(r.m, rel=1e-9, abs=1e-9)


def test_regression_metrics_match_definitions(spark):
    rng = np.random.default_rng(3)
    y = rng.normal(10, 3, 200)
    p = y + rng.normal(0, 1, 200)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(y, p)], "label double, prediction double")
    r = ST.regression_metrics(df).first()
    assert r.n == 200
    assert r.mse == pytest.approx(np.mean((y - p) ** 2))
    assert r.rmse == pytest.approx(np.sqrt(np.mean((y - p) ** 2)))
    assert r.mae == pytest.approx(np.mean(np.abs(y - p)))
    assert r.r2 == pytest.approx(1 - np.sum((y - p) ** 2) / np.sum((y - y.mean()) ** 2))
    assert r.explained_variance == pytest.approx(np.mean((p - y.mean()) ** 2))


def test_corr_matrix_symmetric_unit_diagonal(spark):
    f = L.add_lags(Q._features(spark, SF01), n=3).withColumn("ct_url", F.col("ct_url").cast("double"))
    cols = ["ct_url", "lag_1", "lag_2", "lag_3"]
    m = {(r.row_var, r.col_var): r.corr for r in ST.corr_matrix(f, cols).collect()}
    assert len(m) == 16
    for a in cols:
        assert m[(a, a)] == 1.0
        for b in cols:
            assert m[(a, b)] == m[(b, a)]
    pdf = f.select(*cols).toPandas()
    assert m[("ct_url", "lag_2")] == pytest.approx(pdf["ct_url"].corr(pdf["lag_2"]))


def test_correlations_of_constant_columns_are_null(spark):
    """A column without variance has no correlation; pairs count the rows that have both values."""
    rows = [(1.0, 35.0, 2.0, 9.0), (2.0, 35.0, None, 9.0), (4.0, 35.0, 1.0, None), (3.0, 35.0, 5.0, 8.0)]
    df = spark.createDataFrame(rows, "a double, k double, b double, c double")
    m = {(r.row_var, r.col_var): r.corr for r in ST.corr_matrix(df, ["a", "k", "b", "c"]).collect()}
    assert len(m) == 16 and m["k", "k"] == 1.0
    assert all(m["k", c] is None and m[c, "k"] is None for c in "abc")
    pdf = df.toPandas()
    for a, b in (("a", "b"), ("a", "c"), ("b", "c")):
        assert m[a, b] == pytest.approx(pdf[a].corr(pdf[b]))


def test_correlations_with_a_constant_label_are_null(spark):
    df = spark.createDataFrame([(1.0, 5.0, 35.0), (2.0, 3.0, 35.0)], "a double, b double, label double")
    assert [tuple(r) for r in ST.corr_with(df, ["a", "b"], "label").collect()] == [("a", None), ("b", None)]
    assert [tuple(r) for r in ST.corr_with(df, ["b", "label"], "a").collect()] == [("b", pytest.approx(-1.0)), ("label", None)]


def test_cross_validation_of_a_constant_label(spark):
    """Every setting is fitted; those without an intercept equal the ridge from the moments."""
    rng = np.random.default_rng(5)
    rows = [(float(a), float(b), 35.0, i % 5) for i, (a, b) in enumerate(rng.normal(2, 1, (100, 2)))]
    df = M.assemble(spark.createDataFrame(rows, "a double, b double, label double, fold int"), ["a", "b"])
    cv = M.fit_linear_cv(df, fold_col="fold")
    theirs = {(r, i): [] for r, i, *_ in MO.cross_validate_linear(df, ["a", "b"]).grid}
    for r, i, _, _, e in MO.cross_validate_linear(df, ["a", "b"]).grid:
        theirs[r, i].append(e)
    settings = [(p[k[0]], p[k[1]]) for p in cv.getEstimatorParamMaps() for k in [sorted(p, key=lambda x: x.name, reverse=True)]]
    for setting, rmse in zip(settings, cv.avgMetrics):
        assert rmse == pytest.approx(np.mean(theirs[setting]), abs=1e-6)
    assert cv.bestModel.getFitIntercept() and cv.bestModel.intercept == 35.0
    only = M.fit_linear_cv(df, intercept=[False], fold_col="fold").bestModel
    assert only.getRegParam() in (0.1, 0.01) and not only.getFitIntercept()
    w, _ = MO.ridge(MO.collect_moments(MO.fold_moments(df, ["a", "b"]))[None], only.getRegParam(), False)
    assert np.allclose(only.coefficients, w)


def test_kmeans_cost_and_assignment(spark):
    feats = M.assemble(Q._user_features(spark, SF01), Q.USER_FEATURES).where(F.col("device") == "web").cache()
    model = M.fit_kmeans(feats, 4)
    centers = [np.array(c) for c in model.clusterCenters()]
    rows = M.score(model, feats).select("features", "prediction").collect()
    cost = 0.0
    for r in rows:
        x = r.features.toArray()
        d = [float(np.sum((x - c) ** 2)) for c in centers]
        assert d[r.prediction] == pytest.approx(min(d), rel=1e-9, abs=1e-6)
        cost += d[r.prediction]
    assert M.wssse(model) == pytest.approx(cost, rel=1e-6)
    sweep = M.kmeans_sweep(feats, ks=[2, 3]).collect()
    assert [r.k for r in sweep] == [2, 3] and all(r.wssse > 0 for r in sweep)


def test_cluster_interval_and_stats(spark):
    df = spark.createDataFrame([(0, 1.0), (0, 3.0), (1, 5.0), (1, 5.0), (1, 8.0)], "prediction int, v double")
    out = {(r.prediction, r.v): (r.lo, r.hi) for r in M.cluster_interval(df, "v").collect()}
    assert out[(0, 1.0)] == pytest.approx((1.0, 3.0))
    sd = np.std([5.0, 5.0, 8.0])
    assert out[(1, 8.0)] == pytest.approx((6.0 - sd, 6.0 + sd))
    stats = ST.group_mean_sd(df, "prediction", "v").collect()
    assert [r.prediction for r in stats] == [0, 1] and stats[1].sd == pytest.approx(sd)


def test_cluster_interval_keeps_models_apart(spark):
    df = spark.createDataFrame(
        [("mobile", 0, 1.0), ("mobile", 0, 3.0), ("web", 0, 10.0), ("web", 0, 30.0)],
        "device string, prediction int, v double",
    )
    out = {(r.device, r.v): (r.lo, r.hi) for r in M.cluster_interval(df, "v", ["device", "prediction"]).collect()}
    assert out[("mobile", 1.0)] == pytest.approx((1.0, 3.0))
    assert out[("web", 30.0)] == pytest.approx((10.0, 30.0))


def test_model_roundtrip(spark, labelled, tmp_path):
    model = M.fit_linear(labelled)
    path = M.save_model(model, str(tmp_path / "lr"))
    again = M.load_linear(path)
    assert np.allclose(model.coefficients.toArray(), again.coefficients.toArray())
    assert again.intercept == pytest.approx(model.intercept)


def test_weekday_index_frequency_order(spark):
    f = Q._features(spark, SF01)
    idx = M.index_labels(f, "day_week").select("day_week", "day_week_idx").distinct().collect()
    counts = {r.day_week: r["count"] for r in f.groupBy("day_week").count().collect()}
    order = sorted(counts, key=lambda d: (-counts[d], d))
    assert {r.day_week: r.day_week_idx for r in idx} == {d: float(i) for i, d in enumerate(order)}


def test_hash_split_is_stable_under_repartition(spark):
    hits = Q._hits(spark, SF01)
    a = ST.hash_split(hits, "event_id").select("event_id", "split", "fold")
    b = ST.hash_split(hits.repartition(13), "event_id").select("event_id", "split", "fold")
    assert a.exceptAll(b).count() == 0
    share = a.where(F.col("split") == "train").count() / a.count()
    assert 0.75 < share < 0.85
