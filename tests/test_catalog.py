import pytest

import __spark_entry__ as entry
import oracle
from postlake.plans.catalog import CATALOG


@pytest.fixture(scope="module")
def con(folder):
    return oracle.duck(folder)


# All queries see the smallest tables here; tests/oracle.py compares them on larger ones.
EMPTY_WHEN_SMALL = {"top_trending"}


@pytest.mark.parametrize("name", sorted(CATALOG))
def test_query_equals_sql(spark, con, folder, name):
    problem = oracle.compare(spark, con, name, folder)
    assert problem is None or (problem == "no rows" and name in EMPTY_WHEN_SMALL)


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_query_has_sql():
    assert set(CATALOG) <= set(entry.oracle_sql())
    assert set(CATALOG) <= set(entry.queries())


@pytest.mark.parametrize("name", ["silver_layer", "stream_enrich", "entity_network", "user_engagement", "cross_comparison"])
def test_no_python_in_plans(spark, folder, name):
    plan = entry.queries()[name](spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert "EvalPython" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
