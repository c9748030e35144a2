"""Every query with an oracle matches DuckDB on the small tables (row count,
schema and order-insensitive value hash, as the driver's gate checks)."""

import pytest

import __spark_entry__ as entry
from oracle_harness import compare, duck_connect

from conftest import SF_SMALL

ORACLE = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return duck_connect(SF_SMALL)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, name):
    res = compare(entry.queries()[name](spark, SF_SMALL), duck, ORACLE[name])
    assert res["ok"], res
