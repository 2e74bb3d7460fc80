"""Sinks and plan cuts (S5-S7): default save mode, shared checkpoint folder."""

import pytest
from pyspark.errors import AnalysisException

from trafficlens.runtime import checkpoint_dir
from trafficlens.sources.tables import materialize, read_table, write_table


def test_default_mode_refuses_an_existing_path(spark, tmp_path):
    df = spark.range(5)
    path = write_table(df, str(tmp_path / "t"))
    with pytest.raises(AnalysisException):
        write_table(df, path)
    write_table(spark.range(3), path, mode="overwrite")
    assert read_table(spark, path).count() == 3


def test_materialized_table_lives_in_the_checkpoint_folder(spark):
    cut = materialize(spark.range(7).withColumnRenamed("id", "x"), how="table", name="cut")
    files = cut.inputFiles()
    base = checkpoint_dir(spark).replace("file:", "")
    assert files and all(base in f for f in files)
    assert cut.count() == 7


def test_partitioned_write(spark, tmp_path):
    df = spark.range(10).selectExpr("id", "id % 2 AS parity")
    path = write_table(df, str(tmp_path / "p"), partition_by=["parity"])
    back = read_table(spark, path)
    assert back.where("parity = 1").count() == 5
