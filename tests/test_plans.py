"""Plan checks: the physical plans keep the properties the design relies on."""

import re

from pyspark.sql import functions as F

from trafficlens.operators import devices as D
from trafficlens.operators import load as L
from trafficlens.operators import sessions as S
from trafficlens.sources import fixtures as fx
from trafficlens.sources import logs
from tests.conftest import SF01


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_window_strategy_uses_one_exchange(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sh = S.sessionize(fx.hits(spark, SF01), strategy="window")
        plan = _plan(sh)
        assert plan.count("Exchange hashpartitioning") == 1
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_no_python_in_plans(spark):
    hits = fx.hits(spark, SF01)
    for df in (S.session_table(S.sessionize(hits)), L.load_features(hits, "hour", ["GET"]),
               D.user_features(hits),
               logs.parse_access_log(fx.log_lines(spark, SF01))):
        plan = _plan(df)
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan and "PythonUDF" not in plan


def test_device_filter_reaches_parquet(spark, tmp_path):
    path = str(tmp_path / "hits")
    fx.hits(spark, SF01).write.parquet(path)
    df = D.only_device(spark.read.parquet(path), "mobile").select("cl_ip")
    plan = _plan(df)
    assert "StringContains(user_agent,Mobi)" in plan
    web = _plan(D.only_device(spark.read.parquet(path), "web").select("cl_ip"))
    assert "Not(StringContains(user_agent,Mobi))" in web
    assert "ReadSchema: struct<cl_ip:string,user_agent:string>" in plan


def test_load_features_single_aggregate_no_join(spark):
    plan = _plan(L.load_features(fx.hits(spark, SF01), "second", ["GET", "POST"]))
    assert "Join" not in plan


def test_compact_sessionize_exchanges_are_keyed_not_by_user_alone_for_hits(spark):
    """The full hit rows are only ever shuffled on (user, second), never on user alone."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lines = _plan(S.sessionize(fx.hits(spark, SF01))).splitlines()
        alone = [i for i, line in enumerate(lines) if re.search(r"Exchange hashpartitioning\(cl_ip#\d+, \d+\)", line)]
        assert alone
        for i in alone:  # only the small per-chunk table is shuffled by user alone
            assert re.search(r"HashAggregate\(keys=\[cl_ip#\d+, _chunk#", lines[i + 1]), lines[i + 1]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_first_hit_device_is_a_hash_aggregate(spark):
    hits = fx.hits(spark, SF01).withColumn("session_id", F.lit(1))
    plan = _plan(D.first_hit_device(hits))
    assert "HashAggregate" in plan and "SortAggregate" not in plan and "Sort " not in plan


def test_time_cut_query_computes_the_features_once(spark):
    from trafficlens.plans.queries import QUERIES

    plan = _plan(QUERIES["time_cut"](spark, SF01))
    assert "events" not in plan  # both reads are of the written features


def test_session_prediction_reads_the_written_log(spark):
    from trafficlens.plans.queries import QUERIES

    plan = _plan(QUERIES["session_prediction_fixed"](spark, SF01))
    assert "Window" not in plan and "events.parquet" not in plan


def test_engaged_users_come_out_in_order(spark):
    rows = S.engaged_users(S.session_table(S.sessionize(fx.hits(spark, SF01), gap_secs=21_600))).collect()
    order = [(-r.avg_session_secs, r.cl_ip) for r in rows]
    assert len(rows) > 100 and order == sorted(order)


def test_chained_day_windows_share_one_shuffle(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        f = L.load_features(fx.hits(spark, SF01), "hour", ["GET"])
        plan = _plan(L.moving_average(L.add_lags(L.add_next(f))))
        assert plan.count("Exchange hashpartitioning(day") == 1
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_user_features_join_needs_no_extra_shuffle(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lines = _plan(D.user_features(fx.hits(spark, SF01))).splitlines()
        # both join inputs: each Sort on (device, cl_ip) sits straight on the final aggregate
        sorts = [i for i, line in enumerate(lines) if "Sort [device" in line]
        assert len(sorts) == 2
        for i in sorts:
            assert "HashAggregate(keys=[device" in lines[i + 1]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
