import pytest

from barforge.plans.registry import ORACLES, QUERIES
from tests.conftest import SMALL

#: Too few bars here to learn from; tests/test_chain.py covers their operators.
SLOW = {"forest_cv", "forest_search", "forest_grid_f1", "forest_selection", "importance_by_category", "cpcv_pbo"}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(name, same):
    same(QUERIES[name], ORACLES[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES) - SLOW))
def test_query_without_sql_runs(name, spark):
    assert QUERIES[name](spark, SMALL).count() > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
