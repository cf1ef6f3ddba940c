"""Report queries over the marts. Each returns the small result a report shows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from order_analytics.functions.columns import MONEY, money_ratio, share_percent, short_id
from order_analytics.operators.selection import Found, Wanted, values_at

UNKNOWN = "UNKNOWN"
TOP_LOCATIONS = 10
TOP_CUSTOMERS = 10
HISTOGRAM_BINS = 40
#: Percentiles of revenue that reports show.
PERCENTILES = (50, 90, 95, 99)

# Segment orders and metric labels.
CLV_SEGMENTS = ("HIGH", "MEDIUM", "LOW")
RFM_SEGMENTS = ("VIP", "NEW_CUSTOMER", "CHURN_RISK", "OTHER")
SPEND_LABELS = {
    "AVG_LIFETIME_REVENUE_PER_USER": "Avg lifetime revenue / USER_ID",
    "AVG_ORDER_VALUE": "Average order value",
}


def is_valid_user() -> Column:
    """Neither NULL nor blank; any white space counts as blank here."""
    return F.col("USER_ID").rlike(r"\S")


def valid_users(df: DataFrame) -> DataFrame:
    return df.filter(is_valid_user()) if "USER_ID" in df.columns else df


def _one_row(parts: Sequence[DataFrame]) -> DataFrame:
    """One-row results with different columns, side by side in one row, without a join."""
    names = [name for part in parts for name in part.columns]
    stacked = reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), parts)
    return stacked.agg(*[F.max(name).alias(name) for name in names])


def _sum_where(column: str, condition) -> Column:
    return F.coalesce(F.sum(F.when(condition, F.col(column))), F.lit(0))


# --- overview -------------------------------------------------------------------------------------


def overview_kpis(
    clv: DataFrame,
    rfm: DataFrame,
    churn: DataFrame,
    monthly: DataFrame,
    loyalty: DataFrame,
    restaurants: DataFrame,
    discount: DataFrame,
) -> DataFrame:
    by_month = monthly.groupBy("PERIOD_START_DATE").agg(F.sum("TOTAL_REVENUE").cast(MONEY).alias("REVENUE"))
    return _one_row(
        [
            valid_users(clv).agg(F.avg("LIFETIME_REVENUE").alias("AVG_CLV")),
            valid_users(rfm).agg(F.count_if(F.col("RFM_SEGMENT") == "VIP").alias("VIP_COUNT")),
            valid_users(churn).agg(F.count_if(F.col("CHURN_STATUS") == "AT_RISK").alias("AT_RISK_COUNT")),
            by_month.agg(F.max_by("REVENUE", "PERIOD_START_DATE").alias("LATEST_MONTH_REVENUE")),
            loyalty_member_share(loyalty),
            restaurants.agg(short_id(_first_ranked()).alias("TOP_RESTAURANT")),
            discount_kpis(discount).select("DISCOUNTED_SHARE_PCT"),
        ]
    )


def _first_ranked():
    return F.min_by("RESTAURANT_ID", F.struct("REVENUE_RANK", -F.col("TOTAL_REVENUE"), "RESTAURANT_ID"))


def _restaurant_totals(trend: DataFrame) -> DataFrame:
    return trend.groupBy("RESTAURANT_ID").agg(F.sum("TOTAL_REVENUE").cast(MONEY).alias("TOTAL_REVENUE"))


def overview_top_trend(monthly: DataFrame, restaurants: int = 5) -> DataFrame:
    """Monthly revenue of the restaurants with the largest totals; the broadcast holds that few ids."""
    largest = (
        _restaurant_totals(monthly).orderBy(F.desc("TOTAL_REVENUE"), "RESTAURANT_ID").limit(restaurants)
    )
    kept = monthly.join(F.broadcast(largest.select("RESTAURANT_ID")), on="RESTAURANT_ID", how="left_semi")
    trend = kept.groupBy("PERIOD_START_DATE", "RESTAURANT_ID").agg(
        F.sum("TOTAL_REVENUE").cast(MONEY).alias("TOTAL_REVENUE")
    )
    return trend.withColumn("RESTAURANT_ID_DISPLAY", short_id("RESTAURANT_ID")).orderBy(
        "PERIOD_START_DATE", "RESTAURANT_ID"
    )


# --- customer lifetime value ----------------------------------------------------------------------


def _percentile_places(total: int, percents: Sequence[int]) -> list[tuple[int, int]]:
    """Position (1-based) below each percentile, and the hundredths to move towards the next."""
    return [((total - 1) * percent // 100 + 1, (total - 1) * percent % 100) for percent in percents]


def percentile_places(total: int) -> list[int]:
    """The places that the percentiles of revenue lie between."""
    return [place for below, _ in _percentile_places(total, PERCENTILES) for place in (below, min(below + 1, total))]


def revenue_percentiles(clv: DataFrame, shared: tuple[list[Found | None], int] | None = None) -> dict[int, Decimal | None]:
    """Exact percentiles with linear interpolation, as decimals; None without customers.

    ``shared`` has what stands at ``percentile_places`` and the number of users, where another query found them.
    """
    if shared is None:
        found, sizes = values_at(clv, "LIFETIME_REVENUE", {"named": Wanted(percentile_places, is_valid_user())})
        shared = found["named"], sizes["named"]
    places, total = shared
    if total == 0:
        return dict.fromkeys(PERCENTILES)
    values = [place.value for place in places]
    return {
        percent: low + (high - low) * hundredths / 100
        for percent, low, high, (_, hundredths) in zip(PERCENTILES, values[::2], values[1::2], _percentile_places(total, PERCENTILES), strict=True)
    }


def clv_kpis(clv: DataFrame, percentiles: Mapping[int, Decimal | None] | None = None) -> DataFrame:
    names = {50: "MEDIAN_REVENUE", 90: "P90_REVENUE", 95: "P95_REVENUE", 99: "P99_REVENUE"}
    percentiles = revenue_percentiles(clv) if percentiles is None else percentiles
    totals = valid_users(clv).agg(
        F.count_distinct("USER_ID").alias("USER_COUNT"),
        F.avg("LIFETIME_REVENUE").alias("AVG_REVENUE"),
        F.sum("LIFETIME_REVENUE").cast(MONEY).alias("TOTAL_REVENUE"),
    )
    return totals.withColumns({name: F.lit(percentiles[percent]).cast("decimal(34,4)") for percent, name in names.items()})


def _distribution(df: DataFrame, column: str, segments: Sequence[str]) -> DataFrame:
    """Customers per listed segment, zero where there are none. One aggregate, no join."""
    counts = valid_users(df).agg(*[F.count_if(F.col(column) == name).alias(name) for name in segments])
    return counts.unpivot([], list(segments), column, "USER_COUNT")


def clv_segment_distribution(clv: DataFrame) -> DataFrame:
    counted = _distribution(clv, "CLV_SEGMENT", CLV_SEGMENTS)
    # three rows: the unpartitioned window holds one per segment
    total = F.expr("sum(USER_COUNT) OVER ()")
    return counted.withColumn("SHARE_PCT", share_percent(F.col("USER_COUNT"), total))


def clv_histogram(clv: DataFrame, bins: int = HISTOGRAM_BINS, percentiles: Mapping[int, Decimal | None] | None = None) -> DataFrame:
    """Customers per equal-width revenue bin, over revenues up to the 99th percentile."""
    limit = (revenue_percentiles(clv) if percentiles is None else percentiles)[99]
    kept = valid_users(clv).filter(F.col("LIFETIME_REVENUE") <= F.lit(limit).cast("decimal(34,4)"))
    ends = kept.agg(F.min("LIFETIME_REVENUE"), F.max("LIFETIME_REVENUE")).first()
    low, high = (F.lit(end).cast("double") for end in ends)
    if ends[0] == ends[1]:
        number = F.lit(1).cast("bigint")
    else:
        number = F.least(F.lit(bins), F.width_bucket(F.col("LIFETIME_REVENUE").cast("double"), low, high, F.lit(bins)))
    return kept.groupBy(number.alias("BIN")).agg(F.count(F.lit(1)).alias("USER_COUNT")).orderBy("BIN")


def top_customers(clv: DataFrame, count: int = TOP_CUSTOMERS) -> DataFrame:
    # The columns of this table.
    columns = [
        "USER_ID",
        "LIFETIME_REVENUE",
        "LIFETIME_ORDER_COUNT",
        "LIFETIME_AVG_ORDER_VALUE",
        "FIRST_ORDER_DATE",
        "LAST_ORDER_DATE",
        "CLV_QUINTILE",
        "CLV_SEGMENT",
    ]
    return valid_users(clv).select(columns).orderBy(F.desc("LIFETIME_REVENUE"), "USER_ID").limit(count)


# --- segmentation and churn -----------------------------------------------------------------------


def rfm_segment_distribution(rfm: DataFrame) -> DataFrame:
    return _distribution(rfm, "RFM_SEGMENT", RFM_SEGMENTS)


def rfm_table(rfm: DataFrame, segments: Sequence[str] = RFM_SEGMENTS) -> DataFrame:
    # The columns of this table.
    columns = [
        "USER_ID",
        "LAST_ORDER_DATE",
        "RECENCY_DAYS",
        "FREQUENCY_6M",
        "MONETARY_6M",
        "R_SCORE",
        "F_SCORE",
        "M_SCORE",
        "RFM_SEGMENT",
    ]
    chosen = valid_users(rfm).filter(F.col("RFM_SEGMENT").isin(list(segments))).select(columns)
    return chosen.orderBy("RFM_SEGMENT", F.desc("MONETARY_6M"), "USER_ID")


def churn_kpis(churn: DataFrame) -> DataFrame:
    at_risk = F.count_if(F.col("CHURN_STATUS") == "AT_RISK")
    return valid_users(churn).agg(
        at_risk.alias("AT_RISK_COUNT"),
        F.count_if(F.col("CHURN_STATUS") == "NOT_AT_RISK").alias("NOT_AT_RISK_COUNT"),
        share_percent(at_risk, F.count(F.lit(1))).alias("AT_RISK_RATE_PCT"),
        F.avg("DAYS_SINCE_LAST_ORDER").alias("AVG_DAYS_SINCE_LAST_ORDER"),
    )


def churn_status_counts(churn: DataFrame) -> DataFrame:
    counts = valid_users(churn).groupBy("CHURN_STATUS").agg(F.count(F.lit(1)).alias("USER_COUNT"))
    return counts.orderBy(F.desc("USER_COUNT"), "CHURN_STATUS")


def at_risk_customers(churn: DataFrame) -> DataFrame:
    # The columns of this table.
    columns = [
        "USER_ID",
        "LAST_ORDER_DATE",
        "DAYS_SINCE_LAST_ORDER",
        "AVG_DAYS_BETWEEN_ORDERS",
        "CURRENT_30_DAY_SPEND",
        "PREVIOUS_30_DAY_SPEND",
        "SPEND_CHANGE_PCT",
        "LIFETIME_ORDER_COUNT",
        "CHURN_STATUS",
    ]
    risky = valid_users(churn).filter(F.col("CHURN_STATUS") == "AT_RISK").select(columns)
    return risky.orderBy(F.desc("DAYS_SINCE_LAST_ORDER"), "USER_ID")


# --- sales trends ---------------------------------------------------------------------------------


def with_category(trend: DataFrame) -> DataFrame:
    return trend.withColumn("ITEM_CATEGORY", F.coalesce("ITEM_CATEGORY", F.lit(UNKNOWN)))


def filter_values(trend: DataFrame) -> DataFrame:
    """The distinct restaurants and categories a report can be filtered by."""
    pairs = F.explode(
        F.array(
            F.struct(F.lit("RESTAURANT_ID").alias("FILTER"), F.col("RESTAURANT_ID").alias("VALUE")),
            F.struct(F.lit("ITEM_CATEGORY").alias("FILTER"), F.col("ITEM_CATEGORY").alias("VALUE")),
        )
    )
    values = with_category(trend).select(pairs.alias("PAIR")).select("PAIR.*")
    return values.filter(F.col("VALUE").isNotNull()).distinct().orderBy("FILTER", "VALUE")


def filter_trends(
    trend: DataFrame,
    restaurants: Sequence[str] | None = None,
    categories: Sequence[str] | None = None,
    start: date | None = None,
    end: date | None = None,
) -> DataFrame:
    """Trend rows of the chosen restaurants, categories and period range; None leaves a filter open."""
    chosen = with_category(trend)
    if restaurants is not None:
        chosen = chosen.filter(F.col("RESTAURANT_ID").isin(list(restaurants)))
    if categories is not None:
        chosen = chosen.filter(F.col("ITEM_CATEGORY").isin(list(categories)))
    if start is not None:
        chosen = chosen.filter(F.col("PERIOD_START_DATE") >= F.lit(start))
    if end is not None:
        chosen = chosen.filter(F.col("PERIOD_START_DATE") <= F.lit(end))
    return chosen


def trend_kpis(filtered: DataFrame, categories_chosen: int) -> DataFrame:
    """Revenue and quantity; orders and order value only for exactly one category.

    An order with several categories counts in each of them, so its count does not add up over them.
    """
    orders = F.sum("ORDER_COUNT") if categories_chosen == 1 else F.lit(None).cast("bigint")
    return filtered.agg(
        F.sum("TOTAL_REVENUE").cast(MONEY).alias("TOTAL_REVENUE"),
        orders.alias("ORDER_COUNT"),
        F.sum("ITEM_QUANTITY").alias("ITEM_QUANTITY"),
    ).withColumn("AVERAGE_ORDER_VALUE", money_ratio("TOTAL_REVENUE", F.nullif("ORDER_COUNT", F.lit(0))))


def revenue_over_time(filtered: DataFrame) -> DataFrame:
    totals = filtered.groupBy("PERIOD_START_DATE").agg(F.sum("TOTAL_REVENUE").cast(MONEY).alias("TOTAL_REVENUE"))
    return totals.orderBy("PERIOD_START_DATE")


def orders_over_time(filtered: DataFrame, categories_chosen: int) -> DataFrame:
    """Orders per period; empty unless exactly one category is chosen (see ``trend_kpis``)."""
    rows = filtered if categories_chosen == 1 else filtered.filter(F.lit(False))
    return rows.groupBy("PERIOD_START_DATE").agg(F.sum("ORDER_COUNT").alias("ORDER_COUNT")).orderBy("PERIOD_START_DATE")


def category_revenue(filtered: DataFrame) -> DataFrame:
    totals = filtered.groupBy("ITEM_CATEGORY").agg(F.sum("TOTAL_REVENUE").cast(MONEY).alias("TOTAL_REVENUE"))
    return totals.orderBy(F.desc("TOTAL_REVENUE"), "ITEM_CATEGORY")


def trend_top_restaurants(filtered: DataFrame, count: int = TOP_LOCATIONS) -> DataFrame:
    return _restaurant_totals(filtered).orderBy(F.desc("TOTAL_REVENUE"), "RESTAURANT_ID").limit(count)


# --- loyalty --------------------------------------------------------------------------------------


def loyalty_member_share(loyalty: DataFrame) -> DataFrame:
    members = _sum_where("USER_COUNT", F.col("LOYALTY_STATUS") == "LOYALTY_MEMBER")
    return loyalty.agg(share_percent(members, F.sum("USER_COUNT")).alias("MEMBER_SHARE_PCT"))


def loyalty_spend_unpivot(loyalty: DataFrame) -> DataFrame:
    """Two spend measures as rows, with display labels."""
    long = loyalty.unpivot("LOYALTY_STATUS", list(SPEND_LABELS), "METRIC", "VALUE")
    labels = F.create_map(*[F.lit(part) for pair in SPEND_LABELS.items() for part in pair])
    return long.withColumn("METRIC", labels[F.col("METRIC")])


# --- locations and discounts ----------------------------------------------------------------------


def restaurant_kpis(restaurants: DataFrame) -> DataFrame:
    return restaurants.agg(
        short_id(_first_ranked()).alias("TOP_RESTAURANT"),
        F.count_distinct("RESTAURANT_ID").alias("RESTAURANT_COUNT"),
        F.avg("TOTAL_REVENUE").alias("AVG_REVENUE"),
    )


def restaurant_focus(restaurants: DataFrame, restaurant_id: str) -> DataFrame:
    # The columns of this table.
    return restaurants.filter(F.col("RESTAURANT_ID") == restaurant_id).select(
        "RESTAURANT_ID",
        short_id("RESTAURANT_ID").alias("RESTAURANT_ID_DISPLAY"),
        "REVENUE_RANK",
        "TOTAL_REVENUE",
        "AVERAGE_ORDER_VALUE",
        "REVENUE_PER_USER",
        "ORDER_COUNT",
        "USER_COUNT",
        "AVG_DAILY_ORDERS",
        "AVG_WEEKLY_ORDERS",
    )


def restaurant_table(restaurants: DataFrame) -> DataFrame:
    # The columns of this table.
    return restaurants.select(
        "REVENUE_RANK",
        short_id("RESTAURANT_ID").alias("RESTAURANT_ID_DISPLAY"),
        "RESTAURANT_ID",
        "TOTAL_REVENUE",
        "AVERAGE_ORDER_VALUE",
        "ORDER_COUNT",
        "FIRST_ORDER_DATE",
        "LAST_ORDER_DATE",
        "ACTIVE_CALENDAR_DAYS",
        "AVG_DAILY_ORDERS",
        "ACTIVE_CALENDAR_WEEKS",
        "AVG_WEEKLY_ORDERS",
        "USER_COUNT",
        "REVENUE_PER_USER",
    ).orderBy("REVENUE_RANK", "RESTAURANT_ID")


def _location_bars(restaurants: DataFrame) -> DataFrame:
    # The columns of this table.
    return restaurants.select(
        "RESTAURANT_ID", short_id("RESTAURANT_ID").alias("RESTAURANT_ID_DISPLAY"), "REVENUE_RANK", "TOTAL_REVENUE"
    )


def top_restaurants(restaurants: DataFrame, count: int = TOP_LOCATIONS) -> DataFrame:
    return _location_bars(restaurants).orderBy("REVENUE_RANK", "RESTAURANT_ID").limit(count)


def bottom_restaurants(restaurants: DataFrame, count: int = TOP_LOCATIONS) -> DataFrame:
    return _location_bars(restaurants).orderBy("TOTAL_REVENUE", "RESTAURANT_ID").limit(count)


def discount_kpis(discount: DataFrame) -> DataFrame:
    discounted = _sum_where("ORDER_COUNT", F.col("DISCOUNT_STATUS") == "DISCOUNTED")
    return discount.agg(
        discounted.alias("DISCOUNTED_ORDERS"),
        F.coalesce(F.sum("ORDER_COUNT"), F.lit(0)).alias("TOTAL_ORDERS"),
        share_percent(discounted, F.sum("ORDER_COUNT")).alias("DISCOUNTED_SHARE_PCT"),
    )
