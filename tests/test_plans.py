"""Physical plans: no whole table in one partition, no Python in the data path, pruned scans."""

from __future__ import annotations

import re

import pytest
from conftest import SMALL

from order_analytics import registry

QUERIES = registry.queries()
# One row per listed segment reaches the unpartitioned window of this report.
BOUNDED_WINDOWS = {"clv_segment_distribution"}


def physical_plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", QUERIES)
def test_plan_has_no_python_and_no_cross_join(spark, name):
    plan = physical_plan(QUERIES[name](spark, SMALL))
    assert not re.search(r"Python|ArrowEval|MapInPandas|CartesianProduct|NestedLoop", plan)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - BOUNDED_WINDOWS))
def test_windows_are_partitioned(spark, name):
    plan = physical_plan(QUERIES[name](spark, SMALL))
    for window in re.findall(r"Window \[.*", plan):
        assert re.search(r"\], \[\w+#", window), window


def test_fact_plan_sums_before_it_shuffles(spark):
    data = registry.dataset(spark, SMALL)
    from order_analytics.plans import facts

    plan = physical_plan(facts.order_category_fact(data.lines))
    assert "SortAggregate" not in plan
    assert plan.count("hashpartitioning(ORDER_ID") <= 4


def test_scans_are_pruned(spark):
    plan = physical_plan(QUERIES["sales_trends_weekly"](spark, SMALL))
    assert "USER_ID" not in plan
    calendar = physical_plan(QUERIES["conform_date_dim"](spark, SMALL))
    assert re.search(r"ReadSchema: struct<o_orderdate:\w+>", calendar)


def test_orders_are_read_without_a_shuffle(spark):
    data = registry.dataset(spark, SMALL)
    assert "Exchange" not in physical_plan(data.orders)
