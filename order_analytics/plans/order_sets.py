"""Exact distinct order counts over any set of trend groups.

Order counts of categories do not add up, because an order may have lines of several; so a trend over several categories shows no
order count by default. Here each group keeps the set of its orders as bitmaps, which merge by OR into the exact number.

Orders are numbered densely in the order of restaurant and day, so those of a group stand close together and its bitmaps are few. A
bitmap covers 32,768 numbers (Spark's built-in size); a group has one row for each bitmap that it has orders in.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from order_analytics.operators import ranking
from order_analytics.operators.staging import Stage
from order_analytics.plans import facts

GROUP = ("PERIOD_START_DATE", "RESTAURANT_ID", "ITEM_CATEGORY")


def numbered_orders(orders: DataFrame, stage: Stage) -> DataFrame:
    """The order key with a dense number from 1, sorted by restaurant, day and order."""
    keyed = orders.select(*facts.ORDER_KEY, F.to_date("ORDER_TIMESTAMP").alias("DAY"))
    return ranking.numbered(keyed, ["RESTAURANT_ID", "DAY", "ORDER_ID"], "ORDER_NUMBER", stage).drop("DAY")


def order_sets(order_categories: DataFrame, stage: Stage) -> DataFrame:
    """A bitmap of orders for each day, restaurant, category and range of order numbers.

    Numbers travel, not bitmaps: a group and range has 32,768 of them at most, so it needs no partial bitmaps of 4 KB each.
    Rows are written by category, so that a few categories are read without the bitmaps of the others.
    """
    numbers = numbered_orders(order_categories.filter("LEADS_ORDER"), stage)
    rows = order_categories.select(*facts.ORDER_KEY, F.to_date("ORDER_TIMESTAMP").alias("PERIOD_START_DATE"), "ITEM_CATEGORY")
    named = rows.join(numbers, list(facts.ORDER_KEY))
    thin = named.select(*GROUP, F.bitmap_bucket_number("ORDER_NUMBER").alias("RANGE"), F.bitmap_bit_position("ORDER_NUMBER").alias("BIT"))
    sets = thin.repartition(*GROUP, "RANGE").groupBy("ITEM_CATEGORY", "PERIOD_START_DATE", "RESTAURANT_ID", "RANGE").agg(
        F.bitmap_construct_agg("BIT").alias("ORDERS")
    )
    return stage.keep(sets.select(*GROUP, "RANGE", "ORDERS"), "order-sets")


def order_counts(sets: DataFrame, by: Sequence, categories: Sequence[str] | None = None) -> DataFrame:
    """Distinct orders of the chosen categories (all if None) for each group of ``by``, columns or expressions on the sets."""
    chosen = sets if categories is None else sets.filter(F.col("ITEM_CATEGORY").isin(list(categories)))
    merged = chosen.groupBy(*by, "RANGE").agg(F.bitmap_or_agg("ORDERS").alias("ORDERS"))
    names = [name for name in merged.columns if name not in ("RANGE", "ORDERS")]
    return merged.groupBy(*names).agg(F.sum(F.bitmap_count("ORDERS")).alias("ORDER_COUNT"))
