"""The subpackage's queries against SQL on the smallest tables."""

import pytest

import oracle
from conftest import SMALL
from driftloom.llm.queries import QUERIES


@pytest.mark.parametrize("name", sorted(n for n, (_, sql) in QUERIES.items() if sql))
def test_matches_sql(spark, name):
    query, sql = QUERIES[name]
    assert oracle.difference(query(spark, SMALL), oracle.connect(SMALL), sql) is None


def test_native_queries_have_no_python(spark):
    for name in ("op3_pseudonyms", "op5_licence_scan"):
        plan = QUERIES[name][0](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
        assert not any(word in plan for word in ("Python", "Pandas", "Arrow")), name
