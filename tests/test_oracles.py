"""Every registered query against its SQL, over whole tables."""

import pytest

import __spark_entry__ as entry_module
import compare
from conftest import SF_DIR

# the subpackage for training data has tests of its own
QUERIES = {n: q for n, q in entry_module.queries().items() if n in entry_module.ANALYTICS}
ORACLES = entry_module.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return compare.connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    result = QUERIES[name](spark, SF_DIR)
    names, rows = compare.spark_rows(result)
    expected_names, expected = compare.duck_rows(duck, ORACLES[name])
    assert names == expected_names
    assert rows
    assert rows == expected
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_entry(spark):
    assert entry_module.entry(spark).columns == [
        "cohort_month",
        "cohort_size",
        "period",
        "active_users",
        "retention_pct",
    ]
