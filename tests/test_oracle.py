"""Every registered query against DuckDB on the same tables."""

import pytest
from compare import compare, duck

from wayfare.standin import oracle, registry

QUERIES = registry.queries()
SQL = oracle.oracle_sql()


@pytest.fixture(scope="module")
def connection(sf_dir):
    return duck(sf_dir)


def test_same_names():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, sf_dir, connection):
    frame = QUERIES[name](spark, sf_dir)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python"):
        assert unwanted not in plan
    assert compare(frame, connection, SQL[name]) is None
