"""Registered queries that run their input through a stream."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import col
from ..runtime import scratch_path
from ..streaming import session_ids as SI
from .queries import GAP_6H, Query, _hits


def q_stream_session_ids(spark, sf):
    """All hits through the stream in two runs, by halves of the time span; two
    more runs with a later time move the watermark past every hit. Each run
    goes on from the state of the one before."""
    hits = _hits(spark, sf).select("cl_ip", "date_time", "event_id")
    folder, sink = scratch_path(spark, "stream-hits"), scratch_path(spark, "stream-ids")
    ends = hits.agg(F.min("date_time").alias("a"), F.max("date_time").alias("b")).first()
    middle = ends.a + (ends.b - ends.a) / 2
    halves = [hits.where(col("date_time") < F.lit(middle)), hits.where(col("date_time") >= F.lit(middle))]
    later = [hits.limit(1).select(F.lit("clock").alias("cl_ip"), (F.lit(ends.b) + F.expr(f"INTERVAL {d} DAYS")).alias("date_time"), "event_id") for d in (10, 20)]
    for part in [*halves, *later]:
        part.write.mode("append").parquet(folder)
        stream = spark.readStream.schema(hits.schema).parquet(folder)
        SI.start_session_ids(stream, sink, "1 hour", gap_secs=GAP_6H, keep=["event_id"]).awaitTermination()
    numbered = SI.read_session_ids(spark, sink).where("cl_ip <> 'clock'")
    return numbered.select("event_id", "cl_ip", "date_time", "session_id")


QUERIES: dict[str, Query] = {"stream_session_ids": q_stream_session_ids}
