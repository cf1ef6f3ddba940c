"""One pair of typed tables and everything derived from it, each part built once and shared."""

from __future__ import annotations

from datetime import date
from decimal import Decimal
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from order_analytics import session
from order_analytics.operators import ranking
from order_analytics.operators.selection import Found, Wanted, values_at
from order_analytics.operators.staging import Stage
from order_analytics.plans import facts, marts, order_sets, reports
from order_analytics.sources import keyed


class OrderDataset:
    """Facts and marts over ``items`` and ``options``.

    What several marts read is staged: the order categories (with the orders in them), the customer
    profile and the daily trend. The rest are plans on top. ``release`` frees what was staged.
    """

    def __init__(self, items: DataFrame, options: DataFrame):
        self.spark: SparkSession = items.sparkSession
        session.use_utc(self.spark)
        self.items = items
        self.options = options
        self.stage = Stage(self.spark)

    def release(self) -> None:
        if "placed_lines" in self.__dict__:
            keyed.drop(self.spark, self.placed_lines.path)
        self.stage.release()

    @cached_property
    def lines(self) -> DataFrame:
        return facts.line_fact(self.items, self.options)

    @cached_property
    def placed_lines(self) -> facts.PlacedLines:
        """The line fact as work per order needs it. Order categories that are built later come from it."""
        return facts.place_lines(self.items, self.options, self.stage)

    @cached_property
    def line_sales(self) -> DataFrame:
        placed = self.placed_lines
        return facts.placed_line_sales(self.items, self.options, self.orders, placed)

    @cached_property
    def order_categories(self) -> DataFrame:
        return facts.staged_order_categories(self.items, self.options, self.stage, self.__dict__.get("placed_lines"))

    @cached_property
    def order_sets(self) -> DataFrame:
        return order_sets.order_sets(self.order_categories, self.stage)

    @cached_property
    def orders(self) -> DataFrame:
        return facts.order_fact(self.order_categories)

    @cached_property
    def analysis_date(self) -> date:
        return facts.fetch_analysis_date(self.orders)

    @cached_property
    def customer_orders(self) -> DataFrame:
        return facts.customer_orders(self.orders)

    @cached_property
    def profile(self) -> DataFrame:
        return self.stage.keep(facts.customer_profile(self.customer_orders, self.analysis_date), "profile")

    @cached_property
    def _revenue_places(self) -> tuple[dict[str, list[Found | None]], dict[str, int]]:
        """What opens the value tiles and what the percentiles lie between, from the same counts."""
        wanted = {
            "all": Wanted(lambda total: ranking.tile_openings(total, marts.CLV_TILES)),
            "named": Wanted(reports.percentile_places, reports.is_valid_user()),
        }
        return values_at(self.profile, "LIFETIME_REVENUE", wanted)

    @cached_property
    def revenue_percentiles(self) -> dict[int, Decimal | None]:
        found, sizes = self._revenue_places
        return reports.revenue_percentiles(self.profile, (found["named"], sizes["named"]))

    @cached_property
    def customer_clv(self) -> DataFrame:
        return marts.customer_clv(self.profile, self._revenue_places[0]["all"])

    @cached_property
    def customer_rfm(self) -> DataFrame:
        return marts.customer_rfm(self.profile)

    @cached_property
    def churn_indicators(self) -> DataFrame:
        return marts.churn_indicators(self.profile)

    @cached_property
    def sales_trends_daily(self) -> DataFrame:
        return self.stage.keep(marts.sales_trends_daily(self.order_categories), "daily")

    @cached_property
    def sales_trends_weekly(self) -> DataFrame:
        return marts.sales_trends_weekly(self.sales_trends_daily)

    @cached_property
    def sales_trends_monthly(self) -> DataFrame:
        return marts.sales_trends_monthly(self.sales_trends_daily)

    @cached_property
    def loyalty_program_impact(self) -> DataFrame:
        return marts.loyalty_program_impact(self.profile)

    @cached_property
    def restaurant_performance(self) -> DataFrame:
        return marts.restaurant_performance(self.orders, self.stage)

    @cached_property
    def discount_effectiveness(self) -> DataFrame:
        return marts.discount_effectiveness(self.orders)
