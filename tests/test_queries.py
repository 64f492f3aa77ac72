"""Every registered query against its SQL on the smallest tables."""

import pytest

from compare import connect, difference
from ratelake.plans.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql(spark, con, name):
    df = QUERIES[name](spark, FOLDER)
    assert difference(df, con, ORACLES[name]) is None
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0


def test_entry(spark):
    import __spark_entry__
    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
