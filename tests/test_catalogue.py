"""Every registered query against its SQL, and what its plan must not hold."""

import pytest
from conftest import SMALL
from oracle import connect, differences

import __spark_entry__ as catalogue
import checks

QUERIES = checks.all_queries()
SQL = checks.all_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SMALL)
    assert differences(df, duck, SQL[name]) == []
    plan = df._jdf.queryExecution().executedPlan().toString()
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert unwanted not in plan


def test_entry(spark):
    assert catalogue.entry(spark).count() > 0


@pytest.mark.parametrize(
    "name", ["scd1_upsert", "scd2_versions", "scd3_prev", "i6_author_activity", "i8_tag_performance"]
)
def test_without_broadcast(spark, duck, name):
    """Sides beyond every broadcast limit: equi-joins on shuffled keys, the same rows."""
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for key in keys:
        spark.conf.set(key, "-1")
    try:
        df = QUERIES[name](spark, SMALL)
        assert differences(df, duck, SQL[name]) == []
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        for key in keys:
            spark.conf.unset(key)
    assert "SortMergeJoin" in plan
    assert "NestedLoop" not in plan and "Cartesian" not in plan
