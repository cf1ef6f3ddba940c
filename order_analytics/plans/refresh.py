"""Marts brought up to date from what a sync changed, without the facts of unchanged orders.

The orders that changed lines or options name are built anew, and only they. Their rows before and after, with a sign, are the
change of everything that adds up: trends, counts and revenues are old sums plus signed sums. Distinct users and first and last dates do not
add up, so they are kept as counts per user and per day: a user counts while some order is left, a date while it has orders. What
needs all orders of a customer (dates, gaps, windows, the latest flag) is built anew for the customers hit: those of changed orders and, when the
analysis date moves, those of orders that enter or leave a window.

The order fact is layered: each refresh hides the changed orders of the layers below and puts its own on top; after ``MOST_LAYERS``
it is written as one. All other tables are written at each refresh; they have a row for a customer, a trend group or a pair, none for an order.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from order_analytics import session
from order_analytics.functions.columns import MONEY, PERCENT, count_ratio, money_ratio, month_start, week_start
from order_analytics.operators import membership
from order_analytics.operators.staging import Stage
from order_analytics.plans import facts, marts

MOST_LAYERS = 8

TREND_SUMS = ("TOTAL_REVENUE", "ORDER_COUNT", "ITEM_QUANTITY")
LOYALTY_SUMS = ("USER_COUNT", "ORDER_COUNT", "TOTAL_REVENUE", "REPEAT_USER_COUNT")
PERIODS = {"sales_trends_weekly": week_start, "sales_trends_monthly": month_start}

#: The sums kept beside the marts: their keys, each with the orders and the revenue of its rows.
COUNTERS = {
    "restaurant_days": ("RESTAURANT_ID", "ORDER_DATE"),
    "restaurant_users": ("RESTAURANT_ID", "USER_ID"),
    "discount_users": ("HAS_DISCOUNT", "USER_ID"),
}


def _summed(rows: DataFrame, keys: Sequence[str], sums: Sequence[str], count: str) -> DataFrame:
    """Signed rows summed; groups without rows are gone. Sums keep their types."""
    totals = [F.sum(name).cast(rows.schema[name].dataType).alias(name) for name in sums]
    return rows.groupBy(*keys).agg(*totals).filter(F.col(count) > 0)


def _signed(rows: DataFrame, sign: int) -> DataFrame:
    return rows.withColumn("SIGN", F.lit(sign))


def _trend_change(order_categories: DataFrame) -> DataFrame:
    """What signed order-category rows add to the daily trend."""
    sign = F.col("SIGN")
    return order_categories.groupBy(F.to_date("ORDER_TIMESTAMP").alias("PERIOD_START_DATE"), "RESTAURANT_ID", "ITEM_CATEGORY").agg(
        F.sum(F.col("REVENUE") * sign).cast(MONEY).alias("TOTAL_REVENUE"),
        F.sum(sign).alias("ORDER_COUNT"),
        F.sum(F.col("ITEM_QUANTITY") * sign).alias("ITEM_QUANTITY"),
    )


def _counter_change(orders: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The same for a counter, from signed orders."""
    revenue = F.sum(F.col("ORDER_REVENUE") * F.col("SIGN")).cast(MONEY).alias("REVENUE")
    return orders.groupBy(*keys).agg(F.sum("SIGN").alias("ORDERS"), revenue)


def _loyalty_change(profile: DataFrame) -> DataFrame:
    """The same for the loyalty sums, from signed customers."""
    sign = F.col("SIGN")
    return profile.groupBy(marts.loyalty_status().alias("LOYALTY_STATUS")).agg(
        F.sum(sign).alias("USER_COUNT"),
        F.sum(F.col("LIFETIME_ORDER_COUNT") * sign).alias("ORDER_COUNT"),
        F.sum(F.col("LIFETIME_REVENUE") * sign).cast(MONEY).alias("TOTAL_REVENUE"),
        F.sum(F.when(F.col("LIFETIME_ORDER_COUNT") > 1, sign).otherwise(0)).alias("REPEAT_USER_COUNT"),
    )


def _windows(day: date) -> Column:
    """Which of the windows that end on a day an order lies in."""
    ago = facts.days_before(day)
    return F.array(facts.in_months_before(day), (ago >= 0) & (ago < 30), (ago >= 30) & (ago < 60))


@dataclass(frozen=True)
class MartState:
    """The order fact in layers, the customer profile, trends, counters and loyalty sums, and their analysis date."""

    stage: Stage
    order_categories: DataFrame
    layers: int
    day: date
    tables: dict[str, DataFrame]
    below: MartState | None = None

    @property
    def orders(self) -> DataFrame:
        return facts.order_fact(self.order_categories)

    @property
    def profile(self) -> DataFrame:
        return self.tables["profile"].withColumn("RECENCY_DAYS", facts.days_before(self.day, "LAST_ORDER_DATE"))

    def release(self) -> None:
        """Drop the tables of this state and of those whose layers it reads."""
        self.stage.release()
        if self.below is not None:
            self.below.release()

    def mart(self, name: str) -> DataFrame:
        """A mart as the plans over the full tables have it."""
        if name.startswith("sales_trends"):
            return self.tables[name].withColumn("AVERAGE_ORDER_VALUE", money_ratio("TOTAL_REVENUE", "ORDER_COUNT"))
        if name == "loyalty_program_impact":
            return self._loyalty()
        if name == "restaurant_performance":
            return self._restaurants()
        if name == "discount_effectiveness":
            return self._discounts()
        return getattr(marts, name)(self.profile)

    def _loyalty(self) -> DataFrame:
        return self.tables["loyalty"].select(
            "LOYALTY_STATUS",
            "USER_COUNT",
            "ORDER_COUNT",
            "TOTAL_REVENUE",
            money_ratio("TOTAL_REVENUE", "USER_COUNT").alias("AVG_LIFETIME_REVENUE_PER_USER"),
            "REPEAT_USER_COUNT",
            money_ratio("TOTAL_REVENUE", "ORDER_COUNT").alias("AVG_ORDER_VALUE"),
            count_ratio("REPEAT_USER_COUNT", "USER_COUNT", PERCENT, factor=100).alias("REPEAT_USER_RATE_PCT"),
        )

    def _restaurants(self) -> DataFrame:
        totals = self.tables["restaurant_days"].groupBy("RESTAURANT_ID").agg(
            F.sum("REVENUE").cast(MONEY).alias("TOTAL_REVENUE"),
            F.sum("ORDERS").alias("ORDER_COUNT"),
            F.min("ORDER_DATE").alias("FIRST_ORDER_DATE"),
            F.max("ORDER_DATE").alias("LAST_ORDER_DATE"),
        )
        users = self.tables["restaurant_users"].groupBy(F.col("RESTAURANT_ID").alias("OF")).agg(F.count("USER_ID").alias("USER_COUNT"))
        joined = totals.join(users, F.col("RESTAURANT_ID").eqNullSafe(F.col("OF"))).drop("OF")
        columns = ["RESTAURANT_ID", "TOTAL_REVENUE", "ORDER_COUNT", "USER_COUNT", "FIRST_ORDER_DATE", "LAST_ORDER_DATE"]
        return marts.rated_restaurants(joined.select(columns), self.stage)

    def _discounts(self) -> DataFrame:
        groups = self.tables["discount_users"].groupBy(marts.discount_status().alias("DISCOUNT_STATUS")).agg(
            F.sum("ORDERS").alias("ORDER_COUNT"),
            F.sum("REVENUE").cast(MONEY).alias("TOTAL_REVENUE"),
            F.count("USER_ID").alias("USER_COUNT"),
        )
        return groups.withColumn("AVERAGE_ORDER_VALUE", money_ratio("TOTAL_REVENUE", "ORDER_COUNT"))


def _trends(daily: DataFrame, stage: Stage) -> dict[str, DataFrame]:
    coarser = {
        name: _summed(daily.withColumn("PERIOD_START_DATE", period("PERIOD_START_DATE")), marts.TREND_KEY, TREND_SUMS, "ORDER_COUNT")
        for name, period in PERIODS.items()
    }
    return {name: stage.keep(trend, name) for name, trend in coarser.items()}


def build(items: DataFrame, options: DataFrame) -> MartState:
    """The state of a pair of typed tables, from all their rows."""
    spark = items.sparkSession
    session.use_utc(spark)
    stage = Stage(spark)
    order_categories = facts.staged_order_categories(items, options, stage)
    orders = facts.order_fact(order_categories)
    day = facts.fetch_analysis_date(orders)
    profile = facts.customer_profile(facts.customer_orders(orders), day).drop("RECENCY_DAYS")
    tables = {"profile": stage.keep(profile, "profile")}
    tables["sales_trends_daily"] = stage.keep(_trend_change(_signed(order_categories, 1)), "daily")
    tables |= _trends(tables["sales_trends_daily"], stage)
    tables |= {name: stage.keep(_counter_change(_signed(orders, 1), keys), name) for name, keys in COUNTERS.items()}
    tables["loyalty"] = stage.keep(_loyalty_change(_signed(tables["profile"], 1)), "loyalty")
    return MartState(stage, order_categories, 1, day, tables)


def changed_orders(changes: Sequence[DataFrame]) -> DataFrame:
    """The ids of the orders that changed rows name, before or after; rows are those of ``sync.changed_rows``."""
    ids = [rows.select(F.explode(F.array("OLD.ORDER_ID", "NEW.ORDER_ID")).alias("ORDER_ID")) for rows in changes]
    return reduce(DataFrame.unionAll, ids).filter("ORDER_ID is not null").distinct()


def _hit_customers(signed: DataFrame, orders: DataFrame, before: date, after: date) -> DataFrame:
    """Customers of changed orders, and of orders that the move of the analysis date takes into or out of a window."""
    hit = facts.customer_orders(signed.select("USER_ID"))
    if before != after:
        moved = orders.filter(_windows(before) != _windows(after)).select("USER_ID")
        hit = hit.unionAll(facts.customer_orders(moved))
    return hit.distinct()


def refresh(state: MartState, items: DataFrame, options: DataFrame, changes: Sequence[DataFrame]) -> MartState:
    """The state after the changes; ``items`` and ``options`` are the tables after them. The old state stays readable until it is released."""
    stage = Stage(items.sparkSession)
    ids = membership.keep(changed_orders(changes), stage)
    theirs = [membership.inside(rows, ids, F.col("ORDER_ID")) for rows in (items, options)]
    fresh = facts.staged_order_categories(*theirs, stage)
    gone, left = membership.split(state.order_categories.select(fresh.columns), ids, F.col("ORDER_ID"), stage)
    signed = stage.keep(_signed(gone, -1).unionAll(_signed(fresh, 1)), "signed-order-categories")
    layered = left.unionAll(fresh)
    layers = state.layers + 1
    if layers > MOST_LAYERS:
        layered, layers = stage.keep(layered, "order-categories"), 1
    orders = facts.order_fact(layered)
    signed_orders = signed.filter("LEADS_ORDER").select(
        "RESTAURANT_ID", F.col("ORDER_USER").alias("USER_ID"), "HAS_DISCOUNT", "ORDER_REVENUE", F.to_date("ORDER_TIMESTAMP").alias("ORDER_DATE"), "SIGN"
    )

    def moved(name: str, change: DataFrame, keys: Sequence[str], sums: Sequence[str], count: str) -> DataFrame:
        held = state.tables[name]
        return stage.keep(_summed(held.unionAll(change.select(held.columns)), keys, sums, count), name)

    daily = _trend_change(signed)
    tables = {"sales_trends_daily": moved("sales_trends_daily", daily, marts.TREND_KEY, TREND_SUMS, "ORDER_COUNT")}
    for name, period in PERIODS.items():
        coarser = daily.withColumn("PERIOD_START_DATE", period("PERIOD_START_DATE"))
        tables[name] = moved(name, coarser, marts.TREND_KEY, TREND_SUMS, "ORDER_COUNT")
    for name, keys in COUNTERS.items():
        tables[name] = moved(name, _counter_change(signed_orders, keys), keys, ("ORDERS", "REVENUE"), "ORDERS")

    day = facts.fetch_analysis_date(tables["restaurant_days"])
    hit = stage.keep(_hit_customers(signed_orders, orders, state.day, day), "hit-customers")
    theirs = facts.customer_orders(orders).join(hit, "USER_ID", "left_semi")
    held = state.tables["profile"]
    anew = stage.keep(facts.customer_profile(theirs, day).select(held.columns), "profiles-anew")
    before = held.join(hit, "USER_ID", "left_semi").select(held.columns)
    loyalty = _loyalty_change(_signed(before, -1).unionAll(_signed(anew, 1)))
    tables["loyalty"] = moved("loyalty", loyalty, ("LOYALTY_STATUS",), LOYALTY_SUMS, "USER_COUNT")
    tables["profile"] = stage.keep(held.join(hit, "USER_ID", "left_anti").select(held.columns).unionAll(anew), "profile")
    return MartState(stage, layered, layers, day, tables, state if layers > 1 else None)

