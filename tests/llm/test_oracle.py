"""Corpus queries whose answer SQL can state: Spark and DuckDB agree on sf0.01."""

import duckdb
import pytest

from tests.conftest import SF01
from trafficlens.llm.oracle import ORACLE
from trafficlens.llm.queries import QUERIES


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_query_matches_sql(spark, key):
    con = duckdb.connect()
    for table in ("documents", "pages", "labels", "conversations", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF01}/{table}.parquet'")
    got, want = QUERIES[key](spark, SF01), con.sql(ORACLE[key])
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    rows = sorted(repr(tuple(r)) for r in got.select(*columns).collect())
    assert rows and rows == sorted(map(repr, want.select(*columns).fetchall()))
