
from pyspark.sql import functions as F

from tests.conftest import SF01
from trafficlens.operators import load as L
from trafficlens.operators import sessions as S
from trafficlens.plans import queries as Q
from trafficlens.sources.tables import materialize


def test_lags_mean_equals_frame_moving_average(spark):
    f = Q._features(spark, SF01)
    lags = L.add_lags(f, n=6)
    by_lags = lags.withColumn("m", sum(F.col(f"lag_{k}") for k in range(1, 7)) / 6).select("bucket", "m")
    by_frame = L.moving_average(f, n=6).select("bucket", F.col("autoregressive_value").alias("m"))
    assert by_lags.exceptAll(by_frame).count() == 0 and by_frame.count() == 720


def test_materialize_table_and_checkpoint_keep_rows(spark):
    sh = S.sessionize(Q._hits(spark, SF01), gap_secs=21_600)
    a = materialize(sh, how="table")
    b = materialize(sh, how="checkpoint")
    assert a.exceptAll(sh).count() == 0 and b.exceptAll(sh).count() == 0
    assert "Window" not in a._jdf.queryExecution().executedPlan().toString()


def test_label_fill_reproduces_reference_and_default_drops(spark):
    f = L.add_next(Q._features(spark, SF01))
    filled = L.label(f, fill=0)
    dropped = L.label(f)
    days = f.select(F.col("bucket").cast("date")).distinct().count()
    assert filled.count() == 720 and dropped.count() == 720 - days
    assert filled.where(F.col("next_load").isNull()).agg(F.max("label")).first()[0] == 0.0


def test_time_cut_by_literal_and_by_interval_agree(spark):
    f = Q._features(spark, SF01)
    latest = f.agg(F.max("bucket")).first()[0]
    by_last = L.time_cut(f, last="6 hours").where("is_holdout").count()
    lit = (latest.replace(minute=0) - __import__("datetime").timedelta(hours=6)).strftime("%Y-%m-%d %H:%M:%S")
    by_cutoff = L.time_cut(f, cutoff=lit).where("is_holdout").count()
    assert by_last == by_cutoff == 7


def test_metrics_equal_spark_regression_metrics(spark):
    from pyspark.mllib.evaluation import RegressionMetrics

    from trafficlens.operators import stats as ST

    ma = L.moving_average(Q._features(spark, SF01)).withColumn("ct_url", F.col("ct_url").cast("double"))
    ours = ST.regression_metrics(ma, label="ct_url", prediction="autoregressive_value").first()
    # the RDD class takes (prediction, observation) pairs
    ref = RegressionMetrics(ma.select("autoregressive_value", "ct_url").rdd.map(tuple))
    assert abs(ours.mse - ref.meanSquaredError) < 1e-9 * max(1.0, ref.meanSquaredError)
    assert abs(ours.rmse - ref.rootMeanSquaredError) < 1e-9 * max(1.0, ref.rootMeanSquaredError)
    assert abs(ours.mae - ref.meanAbsoluteError) < 1e-9 * max(1.0, ref.meanAbsoluteError)
    assert abs(ours.r2 - ref.r2) < 1e-9
    assert abs(ours.explained_variance - ref.explainedVariance) < 1e-9 * max(1.0, ref.explainedVariance)
