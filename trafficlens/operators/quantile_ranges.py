"""Predicted ranges by quantiles of a cluster (M15, without the assumption that
values spread evenly around the mean).

Each group's values are kept in a quantile sketch (KLL) of bounded size. Sketches
merge, so ranges of devices or of all users come from those of the clusters,
and a huge cluster reaches its task as a few partial sketches.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import col

SIZE = 400  # items of a sketch: a rank error of about 0.7 per cent


def value_sketches(df: DataFrame, keys: Sequence[str], values: Sequence[str], size: int = SIZE) -> DataFrame:
    """``<keys>, <value>_sketch, rows`` for each group; nulls count nowhere."""
    made = [F.kll_sketch_agg_double(col(v).cast("double"), F.lit(size)).alias(f"{v}_sketch") for v in values]
    return df.groupBy(*keys).agg(*made, F.count(F.lit(1)).alias("rows"))


def merge_sketches(sketches: DataFrame, keys: Sequence[str], size: int = SIZE) -> DataFrame:
    """The sketches of coarser groups, from the sketches alone."""
    names = [c for c in sketches.columns if c.endswith("_sketch")]
    return sketches.groupBy(*keys).agg(*[F.kll_merge_agg_double(col(c), F.lit(size)).alias(c) for c in names], F.sum("rows").alias("rows"))


def quantile_ranges(sketches: DataFrame, low: float = 0.1, high: float = 0.9) -> DataFrame:
    """Each sketch replaced by ``<value>_lo, <value>_hi``, the quantiles ``low``
    and ``high`` of the group; null where it has no value."""
    names = [c for c in sketches.columns if c.endswith("_sketch")]
    ends = {}
    for c in names:
        for end, rank in (("lo", low), ("hi", high)):
            some = F.kll_sketch_get_n_double(col(c)) > 0
            ends[f"{c.removesuffix('_sketch')}_{end}"] = F.when(some, F.kll_sketch_get_quantile_double(col(c), F.lit(rank)))
    return sketches.withColumns(ends).drop(*names)


def quantile_interval(
    clustered: DataFrame, values: Sequence[str], cluster: Sequence[str] = ("prediction",), low: float = 0.1, high: float = 0.9
) -> DataFrame:
    """Each row plus ``<value>_lo, <value>_hi`` of its cluster."""
    ranges = quantile_ranges(value_sketches(clustered, list(cluster), values), low, high)
    return clustered.join(ranges.drop("rows"), list(cluster))


def coverage(rows: DataFrame, values: Sequence[str]) -> DataFrame:
    """One row: the share of rows whose value lies in its range, per value, for
    judging ranges on rows that did not make them."""
    inside = [F.avg(col(v).between(col(f"{v}_lo"), col(f"{v}_hi")).cast("double")).alias(v) for v in values]
    return rows.agg(*inside)
