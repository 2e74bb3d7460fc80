"""Registered queries on distinct URLs from sketches."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import col
from ..operators import sketches as SK
from ..sources.tables import materialize
from .queries import GAP_6H, Query, _session_hits

UNITS = (("session", ["cl_ip", "session_id"], None), ("user", ["cl_ip"], None), ("minute", [], "minute"), ("hour", [], "hour"), ("day", [], "day"))


def q_url_sketch_totals(spark, sf):
    """Per unit: groups, hits, and groups whose distinct URLs by sketch are
    off the exact count by more than three standard errors."""
    log = materialize(_session_hits(spark, sf, GAP_6H).select("cl_ip", "session_id", "date_time", "request_url"), name="session-log")
    base = materialize(SK.url_sketches(log, ["cl_ip", "session_id"], values=["request_url"]), name="url-sketches")
    out = None
    for name, keys, unit in UNITS:
        exact = log.withColumn("bucket", F.date_trunc(unit, "date_time").cast("timestamp_ntz")) if unit else log
        by = [*keys, *(["bucket"] if unit else [])]
        want = exact.groupBy(*by).agg(F.count_distinct("request_url").alias("exact"))
        got = SK.estimates(SK.roll_up(base, keys, unit))
        both = got.join(want, by)
        off = F.abs(col("dist_request_url") - col("exact")) > F.greatest(F.lit(1.0), F.lit(SK.relative_error()) * col("exact"))
        row = both.agg(F.lit(name).alias("unit"), F.count(F.lit(1)).alias("groups"), F.sum("hits").alias("hits"), F.count_if(off).alias("off"))
        out = row if out is None else out.unionByName(row)
    return out


QUERIES: dict[str, Query] = {"url_sketch_totals": q_url_sketch_totals}
