"""Every catalogue query against its SQL on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry_points
import oracle
from conftest import SMALL
from driftloom.catalogue import CATALOGUE

QUERIES, SQL = entry_points.queries(), entry_points.oracle_sql()
OWN = sorted(name for name in SQL if name in CATALOGUE)


@pytest.fixture(scope="module")
def duck():
    connection = oracle.connect(SMALL)
    yield connection
    connection.close()


@pytest.mark.parametrize("name", OWN)
def test_matches_sql(spark, small, duck: duckdb.DuckDBPyConnection, name):
    df = QUERIES[name](spark, small)
    assert oracle.difference(df, duck, SQL[name]) is None
    plan = df._jdf.queryExecution().executedPlan().toString()
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert unwanted not in plan or (unwanted == "ArrowEvalPython" and ("chi_square" in plan or "ks_p_exact" in plan))


def test_entry_has_rows(spark):
    assert entry_points.entry(spark).count() > 100


def test_every_query_has_a_callable_and_sql_only_for_known_ones():
    assert set(SQL) <= set(QUERIES)
    assert all(callable(q) for q in QUERIES.values())
