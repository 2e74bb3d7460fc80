"""Ranges by quantile sketches: ranks, merging, coverage of held-out users."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from trafficlens.operators import quantile_ranges as QR
from trafficlens.operators import stats as ST


@pytest.fixture(scope="module")
def users(spark):
    rng = np.random.default_rng(8)
    rows = [(i, int(k), float(rng.exponential(10.0 * (k + 1))), float(rng.normal(k, 2))) for i, k in enumerate(rng.choice(3, 30_000, p=[0.7, 0.29, 0.01]))]
    return spark.createDataFrame(rows, "id long, prediction int, secs double, urls double").repartition(6).cache()


def test_quantiles_have_the_right_ranks(users):
    ranges = QR.quantile_ranges(QR.value_sketches(users, ["prediction"], ["secs", "urls"]), 0.1, 0.9)
    for v in ("secs", "urls"):
        for r in users.join(ranges, "prediction").groupBy("prediction").agg(F.avg((F.col(v) <= F.col(f"{v}_lo")).cast("int")).alias("lo"), F.avg((F.col(v) <= F.col(f"{v}_hi")).cast("int")).alias("hi")).collect():
            assert abs(r.lo - 0.1) < 0.025 and abs(r.hi - 0.9) < 0.025


def test_held_out_users_are_covered_as_promised(users):
    split = ST.hash_split(users, "id")
    train, test = split.where("split = 'train'"), split.where("split = 'test'")
    ranges = QR.quantile_ranges(QR.value_sketches(train, ["prediction"], ["secs", "urls"])).drop("rows")
    share = QR.coverage(test.join(ranges, "prediction"), ["secs", "urls"]).first()
    assert abs(share.secs - 0.8) < 0.02 and abs(share.urls - 0.8) < 0.02


def test_merged_sketches(users):
    fine = QR.value_sketches(users.withColumn("part", F.col("id") % 50), ["prediction", "part"], ["secs"])
    merged = QR.quantile_ranges(QR.merge_sketches(fine, ["prediction"]))
    exact = users.groupBy("prediction").agg(F.percentile("secs", 0.1).alias("lo"), F.percentile("secs", 0.9).alias("hi"), F.count("*").alias("n"))
    for r in merged.join(exact, "prediction").collect():
        assert r.rows == r.n and r.secs_lo == pytest.approx(r.lo, rel=0.25) and r.secs_hi == pytest.approx(r.hi, rel=0.1)


def test_nulls_small_groups_and_empty_tables(spark):
    df = spark.createDataFrame([(1, 5.0), (1, None), (2, None), (3, 1.0), (3, 2.0)], "prediction int, secs double")
    got = {r.prediction: (r.secs_lo, r.secs_hi) for r in QR.quantile_interval(df, ["secs"]).collect()}
    assert got == {1: (5.0, 5.0), 2: (None, None), 3: (1.0, 2.0)}
    assert QR.quantile_interval(df.limit(0), ["secs"]).count() == 0
