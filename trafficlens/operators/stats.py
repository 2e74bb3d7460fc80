"""Statistics as aggregates.

All of these are single aggregate passes with partial aggregation on the map
side; results are small tables, never row data on the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import col


def regression_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row ``n, mse, rmse, r2, mae, explained_variance`` (M9).

    Same definitions as Spark's ``RegressionMetrics`` with label and
    prediction in their named roles (the reference swapped them, Q9):
    r2 = 1 - SS_err / SS_tot, explained variance = mean((prediction - mean label)^2),
    taken in the same single pass as var_pop(prediction) + (mean prediction - mean label)^2.
    Rows missing either value are left out of every figure; r2 is null when
    the label is constant (no variance to explain).
    """
    err = col(label) - col(prediction)
    both = df.where(col(label).isNotNull() & col(prediction).isNotNull())
    return both.agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(err * err).alias("mse"),
        F.sqrt(F.avg(err * err)).alias("rmse"),
        (F.lit(1.0) - F.try_divide(F.sum(err * err), F.count(F.lit(1)) * F.var_pop(label))).alias("r2"),
        F.avg(F.abs(err)).alias("mae"),
        (F.var_pop(prediction) + F.pow(F.avg(prediction) - F.avg(label), 2)).alias("explained_variance"),
    )


def _corr(a: str, b: str) -> Column:
    """Pearson correlation of the rows that have both values; null when one of
    them is constant there (``corr`` fails on that division in ANSI mode)."""
    x, y = F.when(col(b).isNotNull(), col(a)), F.when(col(a).isNotNull(), col(b))
    return F.try_divide(F.try_divide(F.covar_pop(a, b), F.stddev_pop(x)), F.stddev_pop(y))


def corr_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair, long form ``row_var, col_var, corr``.

    One aggregate computes the upper triangle; the matrix is unfolded by
    ``stack`` on that one row. A pair with a constant column has null.
    """
    columns = list(columns)
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    agg = df.agg(*[_corr(a, b).alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
    cells: list[Column] = []
    for i, (a, b) in enumerate(pairs):
        value = F.lit(1.0) if a == b else col(f"c{i}")
        cells.append(F.struct(F.lit(a).alias("row_var"), F.lit(b).alias("col_var"), value.alias("corr")))
        if a != b:
            cells.append(F.struct(F.lit(b).alias("row_var"), F.lit(a).alias("col_var"), value.alias("corr")))
    return agg.select(F.inline(F.array(*cells)))


def corr_with(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """Correlation of each column with ``target``: ``feature, corr`` (M11);
    null when one of the two is constant."""
    agg = df.agg(*[_corr(c, target).alias(f"c{i}") for i, c in enumerate(columns)])
    cells = [F.struct(F.lit(c).alias("feature"), col(f"c{i}").alias("corr")) for i, c in enumerate(columns)]
    return agg.select(F.inline(F.array(*cells)))


def group_mean_sd(df: DataFrame, group: str, value: str) -> DataFrame:
    """Mean and population standard deviation of ``value`` per group, by group.

    ``stddev_pop`` replaces the reference's sqrt(E[x^2] - E[x]^2), which can
    cancel to a negative and give NaN.
    """
    return (
        df.groupBy(group)
        .agg(F.avg(value).alias("mean"), F.stddev_pop(value).alias("sd"), F.count(F.lit(1)).alias("n"))
        .orderBy(group)
    )


def hash_bucket(key: str | Column, buckets: int) -> Column:
    """A stable bucket 0..buckets-1 from the md5 of the key's text (M3)."""
    text = col(key).cast("string")
    return F.pmod(F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint"), F.lit(buckets))


def hash_split(df: DataFrame, key: str, train_percent: int = 80, folds: int = 5) -> DataFrame:
    """Adds ``split`` ('train'/'test') and ``fold`` (0..folds-1) from the key's hash.

    Unlike an unseeded ``randomSplit``, the same row always lands on the same
    side, on any cluster and any partitioning (Q8).
    """
    b = hash_bucket(key, 100)
    return df.withColumns(
        {
            "split": F.when(b < F.lit(train_percent), F.lit("train")).otherwise(F.lit("test")),
            "fold": hash_bucket(F.concat(F.lit("fold:"), col(key).cast("string")), folds).cast("int"),
        }
    )

