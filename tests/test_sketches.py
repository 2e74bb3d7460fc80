"""Distinct counts from sketches against exact counts."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF01
from trafficlens.operators import sessions as S
from trafficlens.operators import sketches as SK
from trafficlens.sources import fixtures as fx
from trafficlens.sources.tables import materialize


@pytest.fixture(scope="module")
def log(spark):
    return materialize(S.sessionize(fx.hits(spark, SF01), gap_secs=21_600))


@pytest.fixture(scope="module")
def base(log):
    return materialize(SK.url_sketches(log, ["cl_ip", "session_id"], values=["url", "request_url"]))


def test_units_equal_exact_counts_within_the_bound(log, base):
    bound = SK.relative_error()
    for keys, unit in ((["cl_ip", "session_id"], None), (["cl_ip"], None), ([], "minute"), ([], "hour"), ([], "day"), (["cl_ip"], "day")):
        exact = log
        if unit:
            exact = log.withColumn("bucket", F.date_trunc(unit, "date_time").cast("timestamp_ntz"))
        by = [*keys, *(["bucket"] if unit else [])]
        want = exact.groupBy(*by).agg(F.count_distinct("url").alias("u"), F.count_distinct("request_url").alias("r"), F.count("*").alias("n"))
        got = SK.estimates(SK.roll_up(base, keys, unit))
        both = got.join(want, by).collect()
        assert len(both) == want.count() == got.count()
        assert all(r.hits == r.n and abs(r.dist_url - r.u) <= max(1, bound * r.u) for r in both)
        assert all(abs(r.dist_request_url - r.r) <= max(1, bound * r.r) for r in both)


def test_rolling_up_in_steps_changes_nothing(base):
    minute = SK.roll_up(base, ["cl_ip"], "minute")
    once, twice = SK.estimates(SK.roll_up(base, ["cl_ip"], "day")), SK.estimates(SK.roll_up(minute, ["cl_ip"], "day"))
    assert once.exceptAll(twice).count() == 0


def test_units_read_the_sketches_only(base):
    plan = SK.estimates(SK.roll_up(base, [], "hour"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "user_agent" not in plan


def test_large_sets_nulls_and_empty_tables(spark):
    many = spark.range(300_000).select(F.lit("a").alias("cl_ip"), (F.col("id") % 200_000).cast("string").alias("url"))
    many = many.unionByName(spark.createDataFrame([("b", None), ("c", "x"), ("c", "x")], "cl_ip string, url string"))
    got = {r.cl_ip: (r.dist_url, r.hits) for r in SK.estimates(SK.url_sketches(many, ["cl_ip"], unit=None)).collect()}
    assert abs(got["a"][0] - 200_000) <= SK.relative_error() * 200_000 and got["a"][1] == 300_000
    assert got["b"] == (0, 1) and got["c"] == (1, 2)
    assert SK.estimates(SK.url_sketches(many.limit(0), ["cl_ip"], unit=None)).count() == 0
