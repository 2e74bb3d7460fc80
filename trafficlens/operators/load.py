"""Time-bucketed load features, next-step label, lags and the moving-average
forecast (F2, F5, P6-P7, P13-P16, P19-P20, A6-A8, A11, J1-J2, W4-W6).

The reference builds the per-second table from three aggregates and two
joins (means, distinct calendar attributes, a pivot of request types). Here
it is one ``groupBy`` on the bucket: calendar attributes are functions of the
bucket, and request-type counts are ``count_if`` columns, so there is one
shuffle, partial aggregation on the map side, and no join.

Next/lag windows are partitioned by calendar day and ordered by the bucket
timestamp (the reference used the weekday name and an unpadded string key;
on data under a week the partitions are the same). A day partition holds at
most 86,400 second buckets, however much traffic there is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import col, day_quarter, non_negative, time_bucket, weekday_name

# fixed values: the feature names in the order the models take them
FEATURE_COLUMNS = ["avg_rqpt", "avg_bckpt", "avg_respt", "avg_recb", "avg_sentb", "ct_url", "GET", "POST"]


def request_type_counts(
    hits: DataFrame, unit: str = "second", ts: str = "date_time", method: str = "request_type"
) -> DataFrame:
    """``bucket, request_type, hits``: the pivot of request types in long form.

    Every type of the data has its rows, however many types there are (they are
    client text, so scanners make up new ones): no list of types is looked up,
    and nothing goes through the driver. Hits without a type count under null.
    """
    timed = hits.where(col(ts).isNotNull())
    return timed.groupBy(time_bucket(ts, unit).alias("bucket"), col(method).alias("request_type")).agg(
        F.count(F.lit(1)).alias("hits")
    )


def load_features(
    hits: DataFrame,
    unit: str,
    methods: Sequence[str],
    ts: str = "date_time",
    method: str = "request_type",
) -> DataFrame:
    """One row per bucket that has hits: ``bucket``, its calendar ``day``, five
    means, ``ct_url`` (distinct URLs), ``quarter``, ``day_quarter``, ``hour``,
    ``day_week`` and one hit count per request type (0 when absent).

    The ``day`` column is the partition key of the next/lag windows; carrying
    it as a column lets chained windows share one shuffle.

    Processing times of ``-1`` (no backend) are left out of the means.
    ``methods`` names the request types that become columns;
    ``request_type_counts`` has all types in long form.
    """
    timed = hits.where(col(ts).isNotNull())
    bucket = time_bucket(ts, unit).alias("bucket")
    counts = [F.count_if(col(method) == F.lit(m)).alias(m) for m in methods]
    agg = timed.groupBy(bucket).agg(
        F.avg(non_negative("request_processing_time")).alias("avg_rqpt"),
        F.avg(non_negative("backend_processing_time")).alias("avg_bckpt"),
        F.avg(non_negative("response_processing_time")).alias("avg_respt"),
        F.avg("received_bytes").alias("avg_recb"),
        F.avg("sent_bytes").alias("avg_sentb"),
        F.count_distinct("url").alias("ct_url"),
        *counts,
    )
    return agg.select(
        "bucket",
        col("bucket").cast("date").alias("day"),
        "avg_rqpt", "avg_bckpt", "avg_respt", "avg_recb", "avg_sentb", "ct_url",
        F.quarter("bucket").alias("quarter"),
        day_quarter("bucket").alias("day_quarter"),
        F.hour("bucket").alias("hour"),
        weekday_name("bucket").alias("day_week"),
        *[F.col(f"`{m}`") for m in methods],
    )


def ensure_methods(features: DataFrame, methods: Sequence[str]) -> DataFrame:
    """Add a 0 count column for each request type the data did not have."""
    missing = {m: F.lit(0).cast("bigint") for m in methods if m not in features.columns}
    return features.withColumns(missing) if missing else features


_CALENDAR = ("day", "quarter", "day_quarter", "hour", "day_week")


def densify(
    features: DataFrame, unit: str = "second", ts: str = "bucket", counts: Sequence[str] | None = None
) -> DataFrame:
    """Add the missing buckets between the first and last bucket of each day
    (the ``fill_gaps`` option of Q6), so "next" and "lag" mean the next and
    previous bucket in time rather than the next one present.

    Counts are 0 in the gaps (``counts``; by default ``ct_url`` and the
    request-type columns, i.e. the bigint columns of ``load_features``), every
    other column is null there, calendar attributes are recomputed. Apply it
    before ``add_next`` / ``add_lags``. The grid is built per day
    with ``sequence`` (at most one day of buckets per row) and joined on the
    bucket; both sides grow with the time span, so it is a shuffle join.
    """
    step = F.expr(f"INTERVAL 1 {unit.upper()}")
    days = features.groupBy(col(ts).cast("date").alias("_day")).agg(F.min(ts).alias("_lo"), F.max(ts).alias("_hi"))
    grid = days.select(F.explode(F.sequence("_lo", "_hi", step)).alias(ts))
    values = features.drop(*[c for c in _CALENDAR if c in features.columns])
    joined = grid.join(values, ts, "left")
    if counts is None:
        counts = [
            f.name for f in values.schema.fields
            if f.name != ts and f.dataType.typeName() == "long" and f.name != "next_load"
        ]
    filled = joined.na.fill(0, subset=list(counts))
    calendar = {
        "day": col(ts).cast("date"),
        "quarter": F.quarter(ts),
        "day_quarter": day_quarter(ts),
        "hour": F.hour(ts),
        "day_week": weekday_name(ts),
    }
    return filled.withColumns({k: v for k, v in calendar.items() if k in features.columns})


def _by_day(features: DataFrame, ts: str, make):
    """Apply window columns partitioned by the calendar day of ``ts``.

    Uses the ``day`` column of a ``load_features`` table (a date column next to
    ``bucket``), so windows chained on it reuse one partitioning; otherwise the
    day is derived from ``ts`` for the call.
    """
    types = dict(features.dtypes)
    if ts == "bucket" and types.get("day") == "date":
        return make(features, Window.partitionBy("day").orderBy(ts))
    keyed = features.withColumn("_day", col(ts).cast("date"))
    return make(keyed, Window.partitionBy("_day").orderBy(ts)).drop("_day")


def add_next(features: DataFrame, value: str = "ct_url", ts: str = "bucket", out: str = "next_load") -> DataFrame:
    """Next present bucket's value within the same day (W4); null on the last bucket of a day."""
    return _by_day(features, ts, lambda df, w: df.withColumn(out, F.lead(value, 1).over(w)))


def label(features: DataFrame, source: str = "next_load", fill: float | None = None, out: str = "label") -> DataFrame:
    """Double label from ``source`` (P7). Rows without one are dropped, or
    filled with ``fill`` as the reference did with 0 (P20, Q7)."""
    value = col(source).cast("double")
    if fill is None:
        return features.where(value.isNotNull()).withColumn(out, value)
    return features.withColumn(out, F.coalesce(value, F.lit(float(fill))))


def fill_zero(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Replace nulls by 0 in numeric columns (P20)."""
    return df.na.fill(0, subset=list(columns))


def add_lags(features: DataFrame, value: str = "ct_url", n: int = 6, ts: str = "bucket") -> DataFrame:
    """``lag_1 .. lag_n`` of ``value`` as double, 0 where the day has no earlier bucket."""
    return _by_day(
        features,
        ts,
        lambda df, w: df.withColumns({f"lag_{k}": F.lag(value, k, 0).over(w).cast("double") for k in range(1, n + 1)}),
    )


def moving_average(
    features: DataFrame, value: str = "ct_url", n: int = 6, ts: str = "bucket", out: str = "autoregressive_value"
) -> DataFrame:
    """Mean of the previous ``n`` values of the day, missing ones counted as 0.

    One frame sum over ``n`` preceding rows divided by ``n`` (not ``avg`` over
    the frame, which would divide by fewer rows at the start of a day).
    """

    def make(df, w):
        total = F.coalesce(F.sum(col(value).cast("double")).over(w.rowsBetween(-n, -1)), F.lit(0.0))
        return df.withColumn(out, total / F.lit(float(n)))

    return _by_day(features, ts, make)


def time_cut(
    features: DataFrame, ts: str = "bucket", cutoff: str | None = None, last: str | None = None
) -> DataFrame:
    """Mark rows at or after a cutoff as holdout.

    ``cutoff`` is a timestamp literal; ``last`` an interval such as
    ``"5 minutes"`` counted back from the latest bucket (A11), computed as a
    scalar subquery, so nothing but one value leaves the executors. The subquery
    evaluates ``features`` a second time: pass a written table (``materialize``).
    """
    if (cutoff is None) == (last is None):
        raise ValueError("give exactly one of cutoff or last")
    if cutoff is not None:
        bound = F.lit(cutoff).cast("timestamp_ntz")
    else:
        latest = features.select(F.max(ts)).scalar()
        bound = latest - F.expr(f"INTERVAL {last}")
    return features.withColumn("is_holdout", col(ts) >= bound)
