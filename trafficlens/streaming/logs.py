"""The batch operators run incrementally on Structured Streaming.

Nothing here is new logic: ``ingest`` is the parse job (S1-S4, S6) applied to
a directory that keeps receiving log files, and ``session_table_stream`` is
the one-aggregate sessioniser (W1-3') with a watermark, so sessions are
emitted once no later hit can extend them. Both keep their progress and state
under the shared checkpoint folder, so a restarted query resumes where it
stopped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.columns import col, epoch_seconds, ntz_from_epoch
from ..operators.sessions import DEFAULT_GAP_SECS, session_windows
from ..sources.logs import parse_access_log, transform_log


def read_log_stream(spark: SparkSession, source_dir: str, mode: str = "lenient", max_files: int | None = None) -> DataFrame:
    """New text files in ``source_dir`` -> parsed lines (with ``is_valid``), as a streaming DataFrame."""
    reader = spark.readStream.format("text")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return transform_log(parse_access_log(reader.load(source_dir), mode=mode), mode=mode)


def ingest(
    spark: SparkSession,
    source_dir: str,
    sink_dir: str,
    checkpoint: str | None = None,
    mode: str = "lenient",
    available_now: bool = True,
) -> StreamingQuery:
    """Parse every new log file into the parquet hits table (append).

    Like the batch parse job, only matched lines become hits. The checkpoint
    defaults to a folder next to the sink (``<sink>_checkpoint``), so running
    the same ingest again resumes where it stopped.
    """
    parsed = read_log_stream(spark, source_dir, mode)
    hits = parsed.where(col("is_valid")).drop("is_valid")
    writer = (
        hits.writeStream.format("parquet")
        .option("path", sink_dir)
        .option("checkpointLocation", checkpoint or sink_dir.rstrip("/") + "_checkpoint")
        .outputMode("append")
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def session_table_stream(
    hits: DataFrame,
    watermark: str,
    user: str = "cl_ip",
    ts: str = "date_time",
    gap_secs: int = DEFAULT_GAP_SECS,
) -> DataFrame:
    """Sessions of a hit stream: ``user, session_start, session_secs, hits``.

    ``watermark`` (such as ``"1 hour"``) is how late a hit may come and still
    be counted; the caller must choose it, because Spark leaves later hits out
    of the stream's sessions, and append output holds back the sessions still
    open when a run ends. Neither is lost: ``ingest`` keeps every hit in the
    hits table, and ``reconcile_sessions`` finds the sessions of that table
    which the stream has not written as they are.

    Times are cut to whole seconds and the window gap is ``gap_secs - 1`` so a
    session splits exactly where the batch sessioniser splits it. With append
    output a session is written once the watermark passes its end.

    When a few clients dominate the traffic, set
    ``spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition=true``
    before starting the query: Spark then merges each client's events into
    sessions inside every partition before the shuffle, so a hot client's part
    of a micro-batch reaches its task as a few session rows (tested).
    """
    if gap_secs < 2:
        raise ValueError("session_table_stream needs gap_secs >= 2 (its window gap is gap_secs - 1)")
    # watermarks need an instant (TIMESTAMP); whole seconds of the wall clock serve
    timed = (
        hits.where(col(user).isNotNull() & col(ts).isNotNull())
        .withColumn("_sec", epoch_seconds(ts))
        .withColumn("_sec_ts", F.timestamp_seconds(col("_sec")))
        .withWatermark("_sec_ts", watermark)
    )
    agg = timed.groupBy(user, F.session_window("_sec_ts", f"{gap_secs - 1} seconds").alias("_w")).agg(
        F.min("_sec").alias("_s0"), F.max("_sec").alias("_s1"), F.count(F.lit(1)).alias("hits")
    )
    return agg.select(
        user,
        ntz_from_epoch("_s0").alias("session_start"),
        (col("_s1") - col("_s0")).alias("session_secs"),
        "hits",
    )


def reconcile_sessions(
    hits: DataFrame,
    written: DataFrame,
    user: str = "cl_ip",
    ts: str = "date_time",
    gap_secs: int = DEFAULT_GAP_SECS,
) -> DataFrame:
    """Sessions of the ingested ``hits`` table (batch, late hits included) and
    of the stream's table, side by side: ``is_current`` says whether the batch
    has exactly this session, ``is_written`` whether the stream's table has.

    Current rows that are not written are sessions the stream left open or that
    late hits have changed; written rows that are not current are the former
    state of the latter, wrong by now. A shuffle join on all four columns.
    """
    keys = [user, "session_start", "session_secs", "hits"]
    seen = written.select(*keys).distinct().withColumn("is_written", F.lit(True))
    batch = session_windows(hits, user=user, ts=ts, gap_secs=gap_secs).select(*keys).withColumn("is_current", F.lit(True))
    return batch.join(seen, keys, "full").withColumns(
        {"is_current": F.coalesce("is_current", F.lit(False)), "is_written": F.coalesce("is_written", F.lit(False))}
    )


_LOCAL_MERGE = "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition"


def start_session_table_stream(
    hits: DataFrame,
    sink_dir: str,
    watermark: str,
    checkpoint: str | None = None,
    user: str = "cl_ip",
    ts: str = "date_time",
    gap_secs: int = DEFAULT_GAP_SECS,
    merge_locally: bool = True,
    available_now: bool = True,
) -> StreamingQuery:
    """Run ``session_table_stream`` into a parquet table (append: each session
    once, when the watermark has passed it).

    With ``merge_locally`` the query merges each client's events into sessions
    inside every partition before the shuffle, so a client holding a large
    share of a micro-batch reaches its task as a few session rows. The setting
    is made for this query only: a streaming query keeps a copy of the session
    settings from its start, and the caller's value is restored right after.
    """
    sessions = session_table_stream(hits, watermark, user=user, ts=ts, gap_secs=gap_secs)
    spark = hits.sparkSession
    before = spark.conf.get(_LOCAL_MERGE, None)
    spark.conf.set(_LOCAL_MERGE, str(merge_locally).lower())
    try:
        writer = (
            sessions.writeStream.format("parquet")
            .option("path", sink_dir)
            .option("checkpointLocation", checkpoint or sink_dir.rstrip("/") + "_checkpoint")
            .outputMode("append")
        )
        writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
        return writer.start()
    finally:
        if before is None:
            spark.conf.unset(_LOCAL_MERGE)
        else:
            spark.conf.set(_LOCAL_MERGE, before)
