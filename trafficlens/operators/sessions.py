"""Sessionising and the session questions (F1, P17-P18, W1-W3, W1-3', A1-A5, A9, O1-O2).

A session of a user is a run of hits where each gap to the previous hit is
under ``gap_secs`` whole seconds. Two exact strategies:

``"window"``  the reference's plan: ``lag`` and a running ``sum`` over one
              window per user. One shuffle, but a user's whole history is
              sorted in one task, and AQE cannot split window partitions.

``"compact"`` (default) skew-safe. Gaps are measured in whole seconds, so the
              session structure depends only on the set of seconds a user was
              seen in. Hits are first reduced to one row per (user, second)
              by a partial (map-side) aggregate, sessions are numbered inside
              fixed chunks of time (default one day) and the chunks are
              stitched with a small per-user table of chunk ends and running
              session counts. Every sort is bounded by ``chunk_secs`` rows per
              task whatever share of the traffic one user (a proxy, a NAT)
              holds. Hits get their ids back by an equi-join on
              (user, second), whose keys spread a hot user over all tasks.
              ``prev_ts`` and the flag still order the hits of one user in one
              second in one task; given a ``tie_break`` column they come from
              a table of one row per (user, time) instead, and no window runs
              over the hits.

All give the same ``session_id`` for every hit, ``prev_ts`` and
``is_new_session`` included (ties in ``ts`` aside, where the reference's flag
is not deterministic either).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import col, epoch_seconds, ntz_from_epoch, seconds_between

DEFAULT_GAP_SECS = 15 * 60
DEFAULT_CHUNK_SECS = 86_400


def _new_session_flag(ts: Column, prev: Column, gap_secs: int) -> Column:
    """0 when the whole-second gap is strictly below ``gap_secs``, else 1; no previous hit -> 1."""
    return F.when(seconds_between(ts, prev) < F.lit(gap_secs), F.lit(0)).otherwise(F.lit(1))


def _drop_unusable(df: DataFrame, user: str, ts: str) -> DataFrame:
    """Hits without user or time never join a session (F1, Q12, Q17): drop them first."""
    return df.where(col(user).isNotNull() & col(ts).isNotNull())


def _sessionize_window(df: DataFrame, user: str, ts: str, gap_secs: int) -> DataFrame:
    w = Window.partitionBy(user).orderBy(ts)  # one spec: one exchange, one sort for both windows
    with_prev = df.withColumn("prev_ts", F.lag(ts, 1).over(w))
    flagged = with_prev.withColumn("is_new_session", _new_session_flag(col(ts), col("prev_ts"), gap_secs))
    # default RANGE frame: rows with equal ts share one session number
    return flagged.withColumn("session_id", F.sum("is_new_session").over(w))


def session_seconds(df: DataFrame, user: str, ts: str) -> DataFrame:
    """One row per (user, whole second) with the last ``ts`` in it and the hit count."""
    # ts is non-null here; the coalesce only tells the optimizer so, which keeps
    # both uses of this table identical and lets Spark reuse its exchange
    sec = F.coalesce(epoch_seconds(ts), F.lit(0))
    return df.groupBy(user, sec.alias("_sec")).agg(
        F.max(ts).alias("_last"), F.count(F.lit(1)).alias("_hits")
    )


def _number_seconds(secs: DataFrame, user: str, gap_secs: int, chunk_secs: int) -> DataFrame:
    """Session ids on the (user, second) table, sorting at most one chunk per task."""
    secs = secs.withColumn("_chunk", F.coalesce(F.floor(col("_sec") / F.lit(chunk_secs)), F.lit(0)))
    wc = Window.partitionBy(user, "_chunk").orderBy("_sec")
    run = wc.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inner_new = (col("_psec").isNotNull() & (col("_sec") - col("_psec") >= F.lit(gap_secs))).cast("int")
    secs = (
        secs.withColumn("_psec", F.lag("_sec", 1).over(wc))
        .withColumn("_plast", F.lag("_last", 1).over(wc))
        .withColumn("_inner_new", inner_new)
        .withColumn("_run", F.sum("_inner_new").over(run))
    )
    # per (user, chunk): first and last second, last ts, new sessions after the first row
    chunks = secs.groupBy(user, "_chunk").agg(
        F.min("_sec").alias("_first"),
        F.max("_sec").alias("_end"),
        F.max("_last").alias("_end_ts"),
        F.sum("_inner_new").alias("_inner"),
    )
    wu = Window.partitionBy(user).orderBy("_chunk")  # rows per user = chunks spanned, small
    first_new = (
        col("_cpsec").isNull() | (col("_first") - col("_cpsec") >= F.lit(gap_secs))
    ).cast("bigint")
    chunks = (
        chunks.withColumn("_cpsec", F.lag("_end", 1).over(wu))
        .withColumn("_cplast", F.lag("_end_ts", 1).over(wu))
        .withColumn("_first_new", first_new)
        .withColumn("_n", col("_first_new") + col("_inner"))
        .withColumn(
            "_offset",
            F.coalesce(F.sum("_n").over(wu.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        )
        .select(user, "_chunk", "_cpsec", "_cplast", "_first_new", "_offset")
    )
    numbered = secs.join(chunks, [user, "_chunk"])
    return numbered.select(
        user,
        "_sec",
        "_last",
        "_hits",
        F.coalesce(col("_plast"), col("_cplast")).alias("_prev_last"),
        F.when(col("_psec").isNull(), col("_first_new")).otherwise(col("_inner_new")).cast("int").alias("_new"),
        (col("_offset") + col("_first_new") + col("_run")).cast("bigint").alias("session_id"),
    )


def _sessionize_compact(df: DataFrame, user: str, ts: str, gap_secs: int, chunk_secs: int) -> DataFrame:
    secs = _number_seconds(session_seconds(df, user, ts), user, gap_secs, chunk_secs)
    keyed = df.withColumn("_sec", F.coalesce(epoch_seconds(ts), F.lit(0)))
    joined = keyed.join(secs.select(user, "_sec", "_prev_last", "session_id"), [user, "_sec"])
    # previous hit inside the same second, else the last hit of the previous second
    ws = Window.partitionBy(user, "_sec").orderBy(ts)
    prev = F.coalesce(F.lag(ts, 1).over(ws), col("_prev_last"))
    out = joined.withColumn("prev_ts", prev).withColumn(
        "is_new_session", _new_session_flag(col(ts), col("prev_ts"), gap_secs)
    )
    return out.select(*df.columns, "prev_ts", "is_new_session", "session_id")


def _sessionize_ties(df: DataFrame, user: str, ts: str, gap_secs: int, chunk_secs: int, tie_break: str) -> DataFrame:
    sec = F.coalesce(epoch_seconds(ts), F.lit(0))
    times = df.groupBy(user, ts).agg(F.min(tie_break).alias("_first")).withColumn("_sec", sec)
    secs = _number_seconds(session_seconds(times, user, ts), user, gap_secs, chunk_secs)
    ws = Window.partitionBy(user, "_sec").orderBy(ts)  # rows per partition = distinct times in a second
    times = times.join(secs.select(user, "_sec", "_prev_last", "session_id"), [user, "_sec"]).select(
        user, ts, "_first", F.coalesce(F.lag(ts, 1).over(ws), col("_prev_last")).alias("_before"), "session_id"
    )
    # no window above this join, so adaptive execution can split a hot (user, time)
    joined = df.join(times, [user, ts])
    out = joined.withColumn("prev_ts", F.when(col(tie_break) == col("_first"), col("_before")).otherwise(col(ts)))
    out = out.withColumn("is_new_session", _new_session_flag(col(ts), col("prev_ts"), gap_secs))
    return out.select(*df.columns, "prev_ts", "is_new_session", "session_id")


def sessionize(
    hits: DataFrame,
    user: str = "cl_ip",
    ts: str = "date_time",
    gap_secs: int = DEFAULT_GAP_SECS,
    strategy: str = "compact",
    chunk_secs: int = DEFAULT_CHUNK_SECS,
    tie_break: str | None = None,
) -> DataFrame:
    """Hits with non-null user and time, plus ``prev_ts``, ``is_new_session`` (int)
    and ``session_id`` (bigint, from 1 per user).

    ``tie_break`` names a column that is not null and differs between hits of
    one user at one time (a row id): of such hits that with the smallest value
    comes first. Without it their order is left open and a user's hits within
    one second meet in one task; with it any share of the hits may fall into
    one second. It belongs to the compact strategy."""
    if gap_secs <= 0 or chunk_secs <= 0:
        raise ValueError("gap_secs and chunk_secs must be positive")
    df = _drop_unusable(hits, user, ts)
    if tie_break is not None and strategy != "compact":
        raise ValueError("tie_break belongs to strategy='compact'")
    if tie_break is not None:
        return _sessionize_ties(df, user, ts, gap_secs, chunk_secs, tie_break)
    if strategy == "window":
        return _sessionize_window(df, user, ts, gap_secs)
    if strategy == "compact":
        return _sessionize_compact(df, user, ts, gap_secs, chunk_secs)
    raise ValueError("strategy must be 'compact' or 'window'")


def session_spans(
    hits: DataFrame,
    user: str = "cl_ip",
    ts: str = "date_time",
    gap_secs: int = DEFAULT_GAP_SECS,
    chunk_secs: int = DEFAULT_CHUNK_SECS,
) -> DataFrame:
    """Session table straight from the (user, second) table, without per-hit ids:
    ``user, session_id, session_secs, hits``."""
    if gap_secs <= 0 or chunk_secs <= 0:
        raise ValueError("gap_secs and chunk_secs must be positive")
    df = _drop_unusable(hits, user, ts)
    secs = _number_seconds(session_seconds(df, user, ts), user, gap_secs, chunk_secs)
    return secs.groupBy(user, "session_id").agg(
        F.min("_sec").alias("_s0"),
        F.max("_sec").alias("_s1"),
        F.sum("_hits").alias("hits"),
    ).select(
        user,
        "session_id",
        (col("_s1") - col("_s0")).alias("session_secs"),
        "hits",
    )


def session_windows(
    hits: DataFrame,
    user: str = "cl_ip",
    ts: str = "date_time",
    gap_secs: int = DEFAULT_GAP_SECS,
    chunk_secs: int = DEFAULT_CHUNK_SECS,
) -> DataFrame:
    """W1-3' as aggregates: Spark's ``session_window`` over whole seconds.

    ``session_window`` merges events whose distance is at most its gap, so a
    whole-second gap of ``gap_secs - 1`` reproduces "split when the gap is
    ``>= gap_secs``". Spark sorts a session-window group by its other keys, so
    the windows are formed per (user, time chunk): no sort holds more than one
    chunk of one user's seconds. Pieces of a session cut by a chunk border are
    joined again by a running flag per user over pieces: at most one piece per
    session and chunk, i.e. bounded by time span / gap plus the chunks spanned,
    not by traffic. One pass over the input; ``session_spans`` is the variant
    whose per-user work is bounded by chunks alone.
    Output: ``user, session_start, session_secs, hits``.
    """
    if gap_secs < 2 or chunk_secs <= 0:
        raise ValueError("session_windows needs gap_secs >= 2 (its window gap is gap_secs - 1) and chunk_secs > 0")
    df = _drop_unusable(hits, user, ts)
    secs = session_seconds(df, user, ts).withColumns(
        {
            "_sec_ts": ntz_from_epoch("_sec"),
            "_chunk": F.coalesce(F.floor(col("_sec") / F.lit(chunk_secs)), F.lit(0)),
        }
    )
    win = F.session_window(col("_sec_ts"), f"{gap_secs - 1} seconds")
    pieces = secs.groupBy(user, "_chunk", win.alias("_w")).agg(
        F.min("_sec").alias("_s0"), F.max("_sec").alias("_s1"), F.sum("_hits").alias("_h")
    )
    # re-join the pieces a chunk border cut: a running flag per user over its
    # pieces, whose number is bounded by the time span / gap plus the chunks
    # spanned, however much traffic the user sends
    wu = Window.partitionBy(user).orderBy("_s0")
    prev_end = F.lag("_s1", 1).over(wu)
    starts = pieces.withColumn(
        "_new", (prev_end.isNull() | (col("_s0") - prev_end >= F.lit(gap_secs))).cast("int")
    ).withColumn("_sid", F.sum("_new").over(wu.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    agg = starts.groupBy(user, "_sid").agg(
        F.min("_s0").alias("_s0"), F.max("_s1").alias("_s1"), F.sum("_h").alias("hits")
    )
    return agg.select(
        user,
        ntz_from_epoch("_s0").alias("session_start"),
        (col("_s1") - col("_s0")).alias("session_secs"),
        "hits",
    )


def session_table(
    session_hits: DataFrame,
    user: str = "cl_ip",
    ts: str = "date_time",
    url: str | None = "url",
    request_url: str | None = "request_url",
) -> DataFrame:
    """One row per (user, session): length in whole seconds (A1), hits, and
    distinct URLs without and with query string (A3, A4; nulls not counted).

    All parts aggregate partially on the map side, so one huge session (a
    proxy that never pauses) does not land whole in one task.
    """
    aggs = [
        seconds_between(F.max(ts), F.min(ts)).alias("session_secs"),
        F.count(F.lit(1)).alias("hits"),
    ]
    if url:
        aggs.append(F.count_distinct(url).alias("dist_url"))
    if request_url:
        aggs.append(F.count_distinct(request_url).alias("dist_request_url"))
    return session_hits.groupBy(user, "session_id").agg(*aggs)


def session_length(sessions: DataFrame, user: str = "cl_ip") -> DataFrame:
    """Length in whole seconds of every session (A1), from ``session_table``."""
    return sessions.select(user, "session_id", "session_secs")


def urls_per_session(sessions: DataFrame, user: str = "cl_ip") -> DataFrame:
    """Distinct URLs per session, without and with query string (A3, A4), from ``session_table``."""
    return sessions.select(user, "session_id", "dist_url", "dist_request_url")


def avg_session_length(sessions: DataFrame) -> DataFrame:
    """Mean session length over all sessions (A2)."""
    return sessions.agg(F.avg("session_secs").alias("avg_session_secs"), F.count(F.lit(1)).alias("sessions"))


def avg_urls_per_session(sessions: DataFrame) -> DataFrame:
    """Mean distinct URLs per session, without and with query string (A5)."""
    return sessions.agg(
        F.avg("dist_url").alias("avg_dist_url"), F.avg("dist_request_url").alias("avg_dist_request_url")
    )


def engagement(sessions: DataFrame, user: str = "cl_ip") -> DataFrame:
    """Mean session length per user."""
    return sessions.groupBy(user).agg(
        F.avg("session_secs").alias("avg_session_secs"), F.count(F.lit(1)).alias("sessions")
    )


def engaged_users(sessions: DataFrame, user: str = "cl_ip") -> DataFrame:
    """All users, longest mean session first, ties by user (O1)."""
    return engagement(sessions, user).orderBy(F.desc("avg_session_secs"), F.asc(user))


def top_users(sessions: DataFrame, k: int = 100, user: str = "cl_ip") -> DataFrame:
    """The ``k`` most engaged users (O2); planned as a per-partition top-k, no global sort."""
    return engaged_users(sessions, user).limit(k)
