"""Parquet tables, plan cuts and caching (S5-S9, S10 helpers)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from ..runtime import scratch_path


def read_table(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Parquet scan (S5); filters and projections reach the scan."""
    return spark.read.parquet(*([path] if isinstance(path, str) else path))


def write_table(
    df: DataFrame,
    path: str,
    mode: str = "errorifexists",
    partition_by: Sequence[str] = (),
    cluster_by: Sequence[str] = (),
) -> str:
    """Parquet sink (S6). ``mode`` defaults to failing on an existing path, as
    the reference's writes do. ``cluster_by`` groups the rows on those columns
    first (S9) with a ``REBALANCE`` hint rather than ``repartition``: rows of a
    key stay together where possible, but AQE splits a partition that one hot
    key would make oversized, so no single task writes a third of the table.
    ``partition_by`` writes a directory per value.
    """
    if cluster_by:
        df = df.hint("rebalance", *cluster_by)
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def materialize(df: DataFrame, how: str = "table", name: str = "stage") -> DataFrame:
    """Cut the plan (S7): write and read back, or a reliable checkpoint.

    Both land in the shared folder named by ``spark.checkpoint.dir``, so the
    result survives the loss of any executor.
    """
    spark = df.sparkSession
    if how == "table":
        path = scratch_path(spark, name)
        df.write.mode("errorifexists").parquet(path)
        return spark.read.parquet(path)
    if how == "checkpoint":
        scratch_path(spark, name)  # makes sure a checkpoint folder is registered
        return df.checkpoint(eager=True)
    raise ValueError("how must be 'table' or 'checkpoint'")


def cache(df: DataFrame) -> DataFrame:
    """Keep a table that is read many times (S8); lost blocks are recomputed."""
    return df.persist(StorageLevel.MEMORY_AND_DISK)
