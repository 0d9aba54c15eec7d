"""Every registered query against its SQL in DuckDB, and the shape of its plan."""

from pathlib import Path

import pytest

import __spark_entry__ as contract
from harness.compare import differences, duck

SMALL = contract.SMALL
QUERIES = contract.core_queries()
SQL = contract.oracle_sql()

pytestmark = pytest.mark.skipif(not Path(SMALL).exists(), reason="needs the given tables")


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


def test_every_query_has_its_sql():
    assert set(QUERIES) <= set(SQL)


def test_entry(spark):
    assert contract.entry(spark).columns == ["com_cd", "com_lb", "dep_cd", "dep_lb", "reg_cd", "reg_lb"]


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_its_sql(spark, con, name):
    _, found = differences(spark, con, SMALL, QUERIES[name], SQL[name])
    assert not found


@pytest.mark.parametrize("name", QUERIES)
def test_plan_has_no_cross_join_and_no_python_rows(spark, name):
    plan = QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert node not in plan
