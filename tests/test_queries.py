import pytest
from compare import difference, oracle

import __spark_entry__ as entry
from tallyloom.workload import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, con, name):
    df = QUERIES[name](spark, SF)
    sql = ORACLES.get(name)
    if sql is None:
        assert df.count() > 0
    else:
        assert difference(df, con, sql) is None
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not any(bad in plan for bad in ("CartesianProduct", "NestedLoopJoin", "Python", "Pandas"))


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
