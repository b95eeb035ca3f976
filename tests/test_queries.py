"""Every registered query against the other engine, as the driver does."""

import oracle
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return oracle.connect(SF)


def test_every_oracle_has_its_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    assert oracle.difference(duck, df, ORACLES[name]) is None
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_gives_rows(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_flagship(spark):
    assert sorted(r.window_id for r in entry.entry(spark).collect()) == list(range(10))
