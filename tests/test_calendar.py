"""Queries that read or search the whole of what they are given."""

from datetime import datetime

import pytest

from barforge.plans.registry import ORACLES, QUERIES


@pytest.fixture
def few_orders(spark, tmp_path):
    """Orders of Monday to Friday, the one of Wednesday a small one, and none on Thursday."""
    rows = [(datetime(2024, 1, d), p) for d, p in ((1, 500_000.0), (2, 450_000.0), (3, 10.0), (5, 400_001.0))]
    spark.createDataFrame(rows, "o_orderdate timestamp_ntz, o_totalprice double").write.parquet(str(tmp_path / "orders.parquet"))
    return str(tmp_path)


def test_days_of_small_orders_are_not_missing(spark, few_orders):
    day = lambda d: datetime(2024, 1, d).date()
    assert [r.date for r in QUERIES["missing_days"](spark, few_orders).collect()] == [day(4)]
    assert [tuple(r) for r in QUERIES["daily_gaps"](spark, few_orders).collect()] == [(day(3), day(5), 1)]
    assert [(r.first_day, r.last_day) for r in QUERIES["month_edges"](spark, few_orders).collect()] == [(day(1), day(5))]
    assert [tuple(r)[:2] for r in QUERIES["missing_months"](spark, few_orders).collect()] == [(1, 0)]
    assert all("o_totalprice" not in ORACLES[f"{k}"] for k in ("missing_days", "missing_months", "daily_gaps", "month_edges"))
