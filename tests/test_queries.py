"""Every registered query against its SQL on the same files."""

import pytest

import __spark_entry__ as entry
from tests.oracle import connect, difference

FOLDER = "/root/testdata/sf0.01"
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def connection():
    return connect(FOLDER)


AVOIDED = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython")


def build(spark, name):
    frame = entry.queries()[name](spark, FOLDER)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert not [bad for bad in AVOIDED if bad in plan]
    return frame


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_agrees_with_sql(spark, connection, name):
    assert difference(build(spark, name), connection, SQL[name]) is None


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(SQL)))
def test_query_without_sql_gives_rows(spark, name):
    assert build(spark, name).count() > 0


def test_pruning_and_pushdown_reach_the_scan(spark):
    plan = entry.queries()["predicates"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(l_quantity,10.0)" in plan and "l_extendedprice" not in plan


def test_entry(spark):
    frame = entry.entry(spark)
    assert frame.count() == 202
    assert "gap_hours" in frame.columns
