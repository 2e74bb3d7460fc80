"""Every registered query with an oracle matches DuckDB at sf0.01 (the driver's check)."""

import pytest

from tests.oracle_compare import SF01_DEFAULT, compare, duck  # noqa: F401
from trafficlens.plans.registry import ORACLE


@pytest.fixture(scope="module")
def con():
    return duck(SF01_DEFAULT)


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_query_matches_oracle(spark, con, key):
    ok, a, b, detail = compare(spark, con, key, SF01_DEFAULT)
    assert a[0] == b[0], f"row count {a[0]} != {b[0]}"
    assert a[1] == b[1], f"columns {a[1]} != {b[1]}"
    spark_types, duck_types = detail[-1]
    assert spark_types == duck_types, "column types differ"
    assert ok, "values differ"
