"""The streaming forms give the batch answers."""

import os
import tempfile

from tests.conftest import SF001
from trafficlens.operators import sessions as S
from trafficlens.sources import fixtures as fx
from trafficlens.sources import logs
from trafficlens.streaming import logs as SL


def test_ingest_stream_equals_batch_parse_and_resumes(spark):
    src = fx.log_text_path(spark, SF001)
    sink = os.path.join(tempfile.mkdtemp(prefix="tl-stream-out-"), "hits")
    SL.ingest(spark, src, sink).awaitTermination(300)
    streamed = spark.read.parquet(sink)
    batch = logs.read_access_log(spark, src).where("is_valid").drop("is_valid")
    assert streamed.count() == batch.count() == 990
    assert streamed.exceptAll(batch.select(*streamed.columns)).count() == 0
    # a second run with the same (default) checkpoint finds nothing new
    SL.ingest(spark, src, sink).awaitTermination(300)
    assert spark.read.parquet(sink).count() == 990


def test_session_stream_equals_batch_sessions(spark):
    src = fx.log_text_path(spark, SF001)
    stream = SL.session_table_stream(SL.read_log_stream(spark, src), gap_secs=21_600, watermark="400 days")
    name = "tl_sessions_stream"
    q = stream.writeStream.format("memory").queryName(name).outputMode("complete").start()
    q.processAllAvailable()
    q.stop()
    got = sorted((r.cl_ip, r.session_secs, r.hits) for r in spark.table(name).collect())
    hits = logs.read_access_log(spark, src)
    want = sorted((r.cl_ip, r.session_secs, r.hits) for r in S.session_windows(hits, gap_secs=21_600).collect())
    assert got == want


def test_session_stream_with_local_merge(spark):
    """Spark's map-side session merge (for a few dominant clients) gives the same sessions."""
    conf = "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition"
    src = fx.log_text_path(spark, SF001)
    spark.conf.set(conf, "true")
    try:
        stream = SL.session_table_stream(SL.read_log_stream(spark, src), gap_secs=21_600, watermark="400 days")
        q = stream.writeStream.format("memory").queryName("tl_sessions_local_merge").outputMode("complete").start()
        q.processAllAvailable()
        plan = q._jsq.streamingQuery().lastExecution().executedPlan().toString()
        q.stop()
    finally:
        spark.conf.unset(conf)
    got = sorted((r.cl_ip, r.session_secs, r.hits) for r in spark.table("tl_sessions_local_merge").collect())
    hits = logs.read_access_log(spark, src)
    want = sorted((r.cl_ip, r.session_secs, r.hits) for r in S.session_windows(hits, gap_secs=21_600).collect())
    assert got == want
    # one merge before the shuffle (map side) and one after it
    assert plan.count("MergingSessions") == 2


def test_session_table_stream_to_parquet_emits_closed_sessions(spark):
    """Append output: every session the watermark has passed is written once, as in batch."""
    from pyspark.sql import functions as F

    conf = "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition"
    src = fx.log_text_path(spark, SF001)
    sink = os.path.join(tempfile.mkdtemp(prefix="tl-sess-out-"), "sessions")
    before = spark.conf.get(conf, None)
    q = SL.start_session_table_stream(SL.read_log_stream(spark, src), sink, gap_secs=21_600, watermark="1 hour")
    q.awaitTermination(300)
    assert spark.conf.get(conf, None) == before  # the caller's setting is untouched
    plan = q._jsq.streamingQuery().lastExecution().executedPlan().toString()
    assert plan.count("MergingSessions") == 2  # merged map-side, then after the shuffle
    got = spark.read.parquet(sink)
    hits = logs.read_access_log(spark, src)
    batch = S.session_windows(hits, gap_secs=21_600)
    # a session is final once the watermark (last event - 1 h) is past its window end (last hit + gap - 1 s)
    last = hits.agg(F.max("date_time")).first()[0]
    closed = batch.where(
        F.expr("session_start + make_interval(0, 0, 0, 0, 0, 0, session_secs + 21599)")
        < F.lit(last) - F.expr("INTERVAL 1 HOUR")
    )
    key = lambda df: sorted((r.cl_ip, r.session_start, r.session_secs, r.hits) for r in df.collect())
    emitted = key(got)
    assert emitted and set(key(closed)) <= set(emitted) and set(emitted) <= set(key(batch))
    # the batch pass over the same hits names the sessions the stream still holds back
    both = SL.reconcile_sessions(hits, got, gap_secs=21_600)
    assert key(both) == key(batch)
    assert key(both.where("is_written")) == emitted and key(both.where("NOT is_written"))
    assert both.where("NOT is_current").count() == 0
    # a late hit changes a written session: its former state is named too
    first = got.orderBy("session_start").first()
    late = hits.where(F.col("cl_ip") == first.cl_ip).limit(1).withColumn("date_time", F.lit(first.session_start) - F.expr("INTERVAL 5 MINUTES"))
    stale = SL.reconcile_sessions(hits.unionByName(late), got, gap_secs=21_600).where("NOT is_current").collect()
    assert [(r.cl_ip, r.session_start, r.hits, r.is_written) for r in stale] == [(first.cl_ip, first.session_start, first.hits, True)]
