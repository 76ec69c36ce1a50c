"""Every registered query against its SQL on the small tables, and the properties its plan must have."""

from __future__ import annotations

import pytest
from conftest import SMALL

from __spark_entry__ import entry, oracle_sql, queries
from tools.check_results import connect, difference

EXPECTED = oracle_sql()
QUERIES = queries()


@pytest.fixture(scope="module")
def db():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(EXPECTED))
def test_result_equals_sql(spark, sf_dir, db, name):
    df = QUERIES[name](spark, sf_dir)
    assert difference(df, db, EXPECTED[name]) is None
    plan = df._jdf.queryExecution().executedPlan().toString()
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert operator not in plan


def test_every_statement_has_a_query():
    assert set(EXPECTED) <= set(QUERIES)


def test_entry_returns_the_fraud_mart(spark):
    df = entry(spark)
    assert df.count() == 149
    assert "fraud_risk_level" in df.columns
