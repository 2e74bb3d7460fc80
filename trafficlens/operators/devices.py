"""Mobile against web.

The reference filters the session log twice per question (mobile, not
mobile) and joins the halves. A ``device`` column does it in one scan: every
grouping below has ``device`` as a key, and hits with a null agent belong to
neither class, as in the reference.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import MOBILE, MOBILE_MARKER, WEB, col, device, epoch_micros, non_negative, seconds_between
from .sessions import DEFAULT_GAP_SECS, sessionize


def with_device(hits: DataFrame, user_agent: str = "user_agent", out: str = "device") -> DataFrame:
    return hits.withColumn(out, device(user_agent))


def only_device(hits: DataFrame, which: str, user_agent: str = "user_agent") -> DataFrame:
    """Hits of one class (F3 / F4) by the plain substring predicate, which
    reaches the parquet reader as ``StringContains`` (or its negation)."""
    has = col(user_agent).contains(MOBILE_MARKER)
    if which == MOBILE:
        return hits.where(has)
    if which == WEB:
        return hits.where(~has)
    raise ValueError(f"device must be {MOBILE!r} or {WEB!r}")


def device_counts(hits: DataFrame, user_agent: str = "user_agent") -> DataFrame:
    """Hits per device class, the null-agent class included."""
    return hits.groupBy(device(user_agent).alias("device")).agg(F.count(F.lit(1)).alias("hits"))


def device_sessions(session_hits: DataFrame, user: str = "cl_ip", ts: str = "date_time") -> DataFrame:
    """Length of each session counted over one device's hits only (A10, Q11)."""
    d = with_device(session_hits)
    return (
        d.where(col("device").isNotNull())
        .groupBy("device", user, "session_id")
        .agg(seconds_between(F.max(ts), F.min(ts)).alias("session_secs"))
    )


def device_session_time(session_hits: DataFrame, user: str = "cl_ip", ts: str = "date_time") -> DataFrame:
    """Mean session length per (device, user) (A10)."""
    return (
        device_sessions(session_hits, user, ts)
        .groupBy("device", user)
        .agg(F.avg("session_secs").alias("session_secs"))
    )


def device_gap(session_hits: DataFrame, user: str = "cl_ip", ts: str = "date_time") -> DataFrame:
    """Users seen on both classes with both means side by side.

    The inner join of the two halves is one ``groupBy(user)`` with conditional
    aggregates (a pivot), followed by a filter: one shuffle, no join.
    """
    per = device_session_time(session_hits, user, ts)
    wide = per.groupBy(user).agg(
        F.max(F.when(col("device") == MOBILE, col("session_secs"))).alias("sess_time_mob"),
        F.max(F.when(col("device") == WEB, col("session_secs"))).alias("sess_time_web"),
    )
    return wide.where(col("sess_time_mob").isNotNull() & col("sess_time_web").isNotNull()).withColumn(
        "diff", col("sess_time_mob") - col("sess_time_web")
    )


def traffic_features(hits: DataFrame, user: str = "cl_ip", url: str = "url") -> DataFrame:
    """Per (device, user): mean request time, mean received bytes, distinct URLs."""
    d = with_device(hits)
    return (
        d.where(col("device").isNotNull())
        .groupBy("device", user)
        .agg(
            F.avg(non_negative("request_processing_time")).alias("avg_rqpt"),
            F.avg("received_bytes").alias("avg_recb"),
            F.count_distinct(url).alias("ct_url"),
        )
    )


def user_features(
    hits: DataFrame,
    user: str = "cl_ip",
    ts: str = "date_time",
    url: str = "url",
    gap_secs: int = DEFAULT_GAP_SECS,
    session_hits: DataFrame | None = None,
) -> DataFrame:
    """``device, user, session_secs, avg_rqpt, avg_recb, ct_url``.

    Session lengths come from the sessionised hits: pass ``session_hits`` if
    they exist already (then ``gap_secs`` is not used), else ``hits`` are
    sessionised here. The traffic half needs no session ids, so it reads the
    plain hits (the same rows: those with a user and a time) instead of
    running the sessioniser a second time. Both halves are aggregated on
    (device, user) and joined on those keys, so the join's inputs arrive
    partitioned alike.
    """
    if session_hits is None:
        if "session_id" in hits.columns:
            raise ValueError("hits already carry session ids: pass that table as session_hits=")
        session_hits = sessionize(hits, user=user, ts=ts, gap_secs=gap_secs)
    times = device_session_time(session_hits, user, ts)
    usable = hits.where(col(user).isNotNull() & col(ts).isNotNull())
    traffic = traffic_features(usable, user, url)
    return times.join(traffic, ["device", user], "inner")


def first_hit_device(
    session_hits: DataFrame, user: str = "cl_ip", ts: str = "date_time", tie_break: Sequence[str] | None = None
) -> DataFrame:
    """Device of each session's first hit, which picks the model to use.

    By default ties at the first instant go to mobile, then web, then no agent.
    Time and device are then one number (microseconds, and the device's rank in
    the last digit), so the aggregate is a ``min`` of a long: a hash aggregate
    with map-side partials and no sort. ``tie_break`` names columns that decide
    ties instead (an event id); that form is ``min_by`` over a struct, which
    Spark runs as a sort aggregate.
    """
    if tie_break is None:
        rank = F.coalesce(F.when(col("user_agent").contains(MOBILE_MARKER), 0).when(col("user_agent").isNotNull(), 1), F.lit(2))
        first = F.min(epoch_micros(ts) * 10 + rank)
        classes = F.array(F.lit(MOBILE), F.lit(WEB), F.lit(None).cast("string"))
        firsts = session_hits.groupBy(user, "session_id").agg(F.pmod(first, F.lit(10)).cast("int").alias("_rank"))
        return firsts.select(user, "session_id", F.get(classes, col("_rank")).alias("first_device"))
    order = F.struct(col(ts), *[col(c) for c in tie_break])
    return session_hits.groupBy(user, "session_id").agg(
        F.min_by(device("user_agent"), order).alias("first_device")
    )


def session_intervals(
    first_devices: DataFrame,
    intervals: DataFrame,
    user: str = "cl_ip",
    device_col: str = "device",
    ranges: Sequence[str] = ("lo", "hi"),
) -> DataFrame:
    """Predicted range for each session: the interval of the user's cluster in
    the model of the session's first-hit device (M15 with M16). Sessions without
    an interval, such as those whose first hit has no agent, keep null ``ranges``.

    ``intervals`` has one row per (device, user) with ``ranges``; it grows with
    the number of users, so this is a shuffle join on (device, user), not a
    broadcast.
    """
    keyed = first_devices.withColumnRenamed("first_device", device_col)
    return keyed.join(intervals.select(device_col, user, *ranges), [device_col, user], "left")
