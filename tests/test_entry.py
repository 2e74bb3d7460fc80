"""The driver contract: entry() on sf0.001, every registered query runs, oracle keys and columns line up."""

import pytest

import __spark_entry__ as E
from tests.conftest import SF001
from tests.oracle_compare import duck


def test_entry_flagship(spark):
    df = E.entry(spark)
    assert df.columns == ["cl_ip", "avg_session_secs", "sessions"]
    rows = df.collect()
    assert 0 < len(rows) <= 100
    secs = [r.avg_session_secs for r in rows]
    assert secs == sorted(secs, reverse=True)


def test_oracle_keys_are_queries():
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


@pytest.mark.parametrize("key", sorted(E.queries()))
def test_query_runs_on_smallest_scale(spark, con, key):
    df = E.queries()[key](spark, SF001)
    assert df.count() > 0
    sql = E.oracle_sql().get(key)
    if sql:
        cur = con.execute(sql)
        assert sorted(d[0] for d in cur.description) == sorted(df.columns)
