"""A third of all hits on one client (a proxy): the skew-safe plans give the exact answers."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tests.conftest import SF01
from trafficlens.operators import devices as D
from trafficlens.operators import sessions as S
from trafficlens.sources import fixtures as fx

HOT_IP = "10.0.0.0"


@pytest.fixture(scope="module")
def skewed(spark):
    """The sf0.01 hits with every third user's traffic moved onto one address."""
    events = fx.table(spark, SF01, "events")
    hits = fx.hits(spark, SF01).join(events.select("event_id", "user_id"), "event_id")
    return hits.withColumn("cl_ip", F.when(F.col("user_id") % 3 == 0, F.lit(HOT_IP)).otherwise(F.col("cl_ip"))).drop(
        "user_id"
    ).cache()


def test_hot_client_holds_a_third(skewed):
    share = skewed.where(F.col("cl_ip") == HOT_IP).count() / skewed.count()
    assert 0.25 < share < 0.42


@pytest.mark.parametrize("gap", [900, 3600])
@pytest.mark.parametrize("chunk", [3600, 86400])
def test_compact_equals_window_on_skew(skewed, gap, chunk):
    cols = ["event_id", "prev_ts", "is_new_session", "session_id"]
    a = S.sessionize(skewed, gap_secs=gap, strategy="window").select(*cols)
    b = S.sessionize(skewed, gap_secs=gap, chunk_secs=chunk).select(*cols)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.mark.parametrize("same_second", [False, True])
def test_tie_break_equals_ordered_window(skewed, same_second):
    """Hits of one time in the order of their id, also with a third of them in one second."""
    hits = skewed
    if same_second:
        hits = hits.withColumn("date_time", F.when(F.col("cl_ip") == HOT_IP, F.expr("timestamp_ntz'2024-01-02 00:00:00'")).otherwise(F.col("date_time")))
    got = S.sessionize(hits, gap_secs=3600, chunk_secs=3600, tie_break="event_id").select("event_id", "prev_ts", "is_new_session", "session_id")
    w = Window.partitionBy("cl_ip").orderBy("date_time", "event_id")
    want = hits.where("cl_ip is not null and date_time is not null").withColumn("prev_ts", F.lag("date_time").over(w))
    gap = F.unix_seconds(F.col("date_time").cast("timestamp")) - F.unix_seconds(F.col("prev_ts").cast("timestamp"))
    want = want.withColumn("is_new_session", F.when(gap < 3600, 0).otherwise(1))
    want = want.withColumn("session_id", F.sum("is_new_session").over(w)).select("event_id", "prev_ts", "is_new_session", "session_id")
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def _window_outputs(node):
    if node.nodeName() == "Window":
        yield node.output().mkString(",")
    for i in range(node.children().size()):
        yield from _window_outputs(node.children().apply(i))


def test_tie_break_runs_no_window_over_hits(skewed):
    plans = [S.sessionize(skewed, tie_break=t)._jdf.queryExecution().optimizedPlan() for t in (None, "event_id")]
    with_hits = [any("user_agent" in out for out in _window_outputs(p)) for p in plans]
    assert with_hits == [True, False]


def test_hot_sessions_cross_chunk_borders(skewed):
    """Some sessions of the hot client run over midnight, so stitching is exercised."""
    sh = S.sessionize(skewed, gap_secs=3600)
    days = sh.where(F.col("cl_ip") == HOT_IP).groupBy("session_id").agg(
        F.countDistinct(F.col("date_time").cast("date")).alias("days")
    )
    assert days.where("days > 1").count() > 0


def test_session_tables_agree_on_skew(skewed):
    st = S.session_table(S.sessionize(skewed, gap_secs=3600)).select("cl_ip", "session_secs", "hits")
    spans = S.session_spans(skewed, gap_secs=3600, chunk_secs=3600).select("cl_ip", "session_secs", "hits")
    windows = S.session_windows(skewed, gap_secs=3600).select("cl_ip", "session_secs", "hits")
    assert st.exceptAll(spans).count() == 0 and spans.exceptAll(st).count() == 0
    assert st.exceptAll(windows).count() == 0 and windows.exceptAll(st).count() == 0


def test_user_features_on_skew(skewed):
    uf = D.user_features(skewed, gap_secs=3600)
    hot = uf.where(F.col("cl_ip") == HOT_IP).collect()
    assert {r.device for r in hot} == {"mobile", "web"}


def test_clustered_write_splits_the_hot_key(spark, skewed, tmp_path):
    """``write_table(cluster_by=...)`` uses REBALANCE: AQE splits the hot key's partition."""
    import glob

    from trafficlens.sources.tables import read_table, write_table

    src = str(tmp_path / "src")
    skewed.repartition(16).write.parquet(src)
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16k")
    try:
        out = write_table(read_table(spark, src), str(tmp_path / "out"), cluster_by=["cl_ip"])
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    files = glob.glob(f"{out}/*.parquet")
    hot_files = [f for f in files if spark.read.parquet(f).where(F.col("cl_ip") == HOT_IP).limit(1).count()]
    assert len(hot_files) > 1
    assert read_table(spark, out).count() == skewed.count()


def test_user_features_with_given_session_log(skewed):
    sh = S.sessionize(skewed, gap_secs=3600)
    a = D.user_features(skewed, session_hits=sh)
    b = D.user_features(skewed, gap_secs=3600)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    with pytest.raises(ValueError):
        D.user_features(sh)
