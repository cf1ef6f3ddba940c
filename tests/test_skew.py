"""Results hold when one order, customer, restaurant and product carry a third of all lines."""

from __future__ import annotations

import re

import duckdb
import pytest
from conftest import SMALL
from oracle_check import connect, differences

import __spark_entry__ as contract
from order_analytics import registry

NAMES = (
    "order_fact",
    "line_sales_fact",
    "order_gaps",
    "customer_clv",
    "customer_rfm",
    "churn_indicators",
    "sales_trends_weekly",
    "restaurant_performance",
    "discount_effectiveness",
    "loyalty_program_impact",
    "clv_kpis",
    "exact_dedup",
    "snapshot_sync_summary",
    "gate_unsafe_join_keys",
)


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    """A third of the lines moved to one order, supplier and part; a third of the orders to one customer."""
    folder = tmp_path_factory.mktemp("skewed")
    connection = duckdb.connect()
    for name in ("orders", "part", "lineitem"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SMALL}/{name}.parquet')")
    moved = {
        "part": "SELECT * FROM part",
        "orders": "SELECT * REPLACE ((CASE WHEN o_orderkey % 3 = 0 THEN 7 ELSE o_custkey END) AS o_custkey) FROM orders",
        "lineitem": """
            WITH numbered AS (SELECT *, row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate) AS n FROM lineitem)
            SELECT CASE WHEN n % 3 = 0 THEN 8 ELSE l_orderkey END AS l_orderkey,
              CASE WHEN n % 3 = 0 THEN 5 ELSE l_partkey END AS l_partkey,
              CASE WHEN n % 3 = 0 THEN 3 ELSE l_suppkey END AS l_suppkey,
              l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus,
              CASE WHEN n % 3 = 0 THEN TIMESTAMP '1995-01-01' + to_days(CAST(n AS INT)) ELSE l_shipdate END AS l_shipdate
            FROM numbered""",
    }
    for name, sql in moved.items():
        connection.execute(f"COPY ({sql}) TO '{folder}/{name}.parquet' (FORMAT parquet)")
    return str(folder)


@pytest.mark.parametrize("name", NAMES)
def test_skewed_tables(spark, skewed, name):
    df = contract.queries()[name](spark, skewed)
    assert differences(df, contract.oracle_sql()[name], connect(skewed)) is None


def test_adaptive_execution_splits_the_hot_order(spark, skewed):
    """The join of lines to their order is split where one order holds a third of the lines."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
    }
    registry.close_all(spark)
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        df = contract.queries()["line_sales_fact"](spark, skewed)
        assert differences(df, contract.oracle_sql()["line_sales_fact"], connect(skewed)) is None
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        for key in settings:
            spark.conf.unset(key)
        registry.close_all(spark)
    assert re.search(r"SortMergeJoin\(skew=true\) \[ORDER_ID#\d+, RESTAURANT_ID#", plan)
