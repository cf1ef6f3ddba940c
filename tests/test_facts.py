"""The order and customer rules on hand-made rows."""

from __future__ import annotations

from datetime import date, timedelta
from decimal import Decimal

import pytest
from builders import ITEM_SCHEMA, OPTION_SCHEMA, ORDER_SCHEMA, item, option, order

from order_analytics.plans import facts, marts
from order_analytics.plans.dataset import OrderDataset

DAY = date(2024, 8, 31)


@pytest.fixture
def data(frame):
    def build(items, options=()):
        return OrderDataset(frame(items, ITEM_SCHEMA), frame(list(options), OPTION_SCHEMA))

    return build


@pytest.fixture
def orders(frame):
    return lambda rows: frame(rows, ORDER_SCHEMA)


def by(df, *key):
    return {tuple(row[name] for name in key) if len(key) > 1 else row[key[0]]: row for row in df.collect()}


def days_ago(days):
    return f"{DAY - timedelta(days=days)} 09:00:00"


def test_same_order_id_at_two_restaurants_is_two_orders(data):
    found = by(data([item(), item(line="L2", restaurant="R2")]).orders, "ORDER_ID", "RESTAURANT_ID")
    assert set(found) == {("O1", "R1"), ("O1", "R2")}


def test_line_revenue_adds_options_to_the_extended_price(data):
    built = data([item(price=19.99, quantity=3)], [option(price=2, quantity=3), option(price=5, name="p")])
    (line,) = built.lines.collect()
    assert line["OPTION_REVENUE"] == Decimal("11.00")
    assert line["LINE_REVENUE"] == Decimal("30.99")
    assert line["OPTION_COUNT"] == 2


def test_a_free_option_of_any_quantity_discounts_the_order(data):
    items = [item(), item(line="L2"), item(order="O2")]
    options = [option(line="L2", price=0, quantity=0), option(order="O2", price=3)]
    found = by(data(items, options).orders, "ORDER_ID")
    assert (found["O1"]["HAS_DISCOUNT"], found["O2"]["HAS_DISCOUNT"]) == (1, 0)
    effect = by(data(items, options).discount_effectiveness, "DISCOUNT_STATUS")
    assert effect["DISCOUNTED"]["TOTAL_REVENUE"] == Decimal("20.00")


def test_order_merges_categories_users_and_flags(data):
    items = [
        item(user=None, loyalty=None, time="2024-05-02 00:10:00", quantity=None),
        item(line="L2", user="u1", loyalty=" true ", time="2024-05-01 23:50:00", quantity=2),
        item(line="L3", category=None, user="u1", price=-3.5),
        item(line="L4", category="Pasta", user="u1"),
    ]
    built = data(items)
    (found,) = built.orders.collect()
    assert (found["USER_ID"], found["LOYALTY_FLAG"], found["TOTAL_ITEM_QUANTITY"]) == ("u1", 1, 4)
    assert found["ORDER_REVENUE"] == Decimal("26.50")
    assert found["ORDER_DATE"] == date(2024, 5, 1)
    daily = by(built.sales_trends_daily, "ITEM_CATEGORY")
    assert {name: row["ORDER_COUNT"] for name, row in daily.items()} == {"Pizza": 1, None: 1, "Pasta": 1}
    assert {row["PERIOD_START_DATE"] for row in daily.values()} == {date(2024, 5, 1)}
    assert daily["Pizza"]["TOTAL_REVENUE"] == Decimal("20.00")


def test_analysis_date_counts_anonymous_orders(data, orders):
    built = data([item(), item(order="O2", user="  ", time="2024-06-01 00:00:00")])
    assert built.analysis_date == date(2024, 6, 1)
    with pytest.raises(RuntimeError):
        facts.fetch_analysis_date(orders([]))


def test_customer_orders_trim_and_drop_blank_users(orders):
    rows = [order("a", None), order("b", ""), order("c", "  "), order("d", "\t"), order("e", " u1 "), order("f", "u1")]
    found = facts.customer_orders(orders(rows)).select("ORDER_ID", "USER_ID").collect()
    assert {tuple(row) for row in found} == {("d", "\t"), ("e", "u1"), ("f", "u1")}


def test_six_month_window_includes_both_ends(orders):
    rows = [order("a", time="2024-02-29 00:00:00"), order("b", time="2024-02-28 23:59:59"), order("c", time=days_ago(0))]
    (found,) = facts.six_month_metrics(orders(rows), DAY).collect()
    assert found["FREQUENCY_6M"] == 2
    (profile,) = facts.customer_profile(orders(rows), DAY).collect()
    assert (profile["FREQUENCY_6M"], profile["MONETARY_6M"]) == (2, Decimal("20.00"))


def test_spend_windows_and_churn_limit(orders):
    ages = {"now": 0, "edge29": 29, "edge30": 30, "edge59": 59, "edge60": 60, "safe": 45, "risk": 46}
    rows = [order(name, user=name, time=days_ago(days)) for name, days in ages.items()]
    found = by(marts.churn_indicators(facts.customer_profile(orders(rows), DAY)), "USER_ID")
    current = {name for name, row in found.items() if row["CURRENT_30_DAY_SPEND"] > 0}
    previous = {name for name, row in found.items() if row["PREVIOUS_30_DAY_SPEND"] > 0}
    assert current == {"now", "edge29"}
    assert previous == {"edge30", "edge59", "safe", "risk"}
    assert {name for name, row in found.items() if row["CHURN_STATUS"] == "AT_RISK"} == {"risk", "edge59", "edge60"}
    assert found["now"]["SPEND_CHANGE_PCT"] is None
    assert found["edge30"]["SPEND_CHANGE_PCT"] == Decimal("-100.00")
    assert found["now"]["AVG_DAYS_BETWEEN_ORDERS"] is None


def test_spend_change_beyond_the_type_is_null(orders):
    rows = [order("a", time=days_ago(1), revenue="999999999999.00"), order("b", time=days_ago(31), revenue="0.01")]
    (found,) = marts.churn_indicators(facts.customer_profile(orders(rows), DAY)).collect()
    assert found["SPEND_CHANGE_PCT"] is None


def test_gaps_follow_the_order_sequence(orders):
    rows = [
        order("b", time="2024-05-01 10:00:00"),
        order("a", time="2024-05-01 10:00:00", restaurant="R2"),
        order("c", time="2024-05-04 08:00:00"),
        order("d", time="2024-05-04 09:00:00"),
        order("x", user="u2"),
    ]
    found = by(facts.order_gaps(orders(rows)), "ORDER_ID")
    assert {name: row["GAP_DAYS"] for name, row in found.items()} == {"a": None, "b": 0, "c": 3, "d": 0, "x": None}
    means = by(facts.average_gaps(orders(rows)), "USER_ID")
    assert means["u1"]["AVG_DAYS_BETWEEN_ORDERS"] == 1.0
    assert means["u2"]["AVG_DAYS_BETWEEN_ORDERS"] is None


def test_membership_follows_the_latest_order_even_without_flag(orders):
    rows = [
        order("a", loyalty=1),
        order("b", time="2024-05-02 00:00:00"),
        order("m", user="u2", loyalty=0),
        order("n", user="u2", loyalty=1),
        order("z", user="u3", loyalty=0),
    ]
    found = by(marts.customer_loyalty_stats(facts.customer_profile(orders(rows), DAY)), "USER_ID")
    assert {user: row["LOYALTY_STATUS"] for user, row in found.items()} == {
        "u1": "NON_MEMBER", "u2": "LOYALTY_MEMBER", "u3": "NON_MEMBER"
    }
    impact = by(marts.loyalty_program_impact(facts.customer_profile(orders(rows), DAY)), "LOYALTY_STATUS")
    assert impact["NON_MEMBER"]["REPEAT_USER_RATE_PCT"] == Decimal("50.00")


def test_clv_with_ties_and_few_customers(orders):
    four = marts.customer_clv(facts.customer_profile(orders([order(f"o{n}", user=f"u{n}") for n in range(4)]), DAY))
    assert sorted(row["CLV_QUINTILE"] for row in four.collect()) == [1, 2, 3, 4]
    seven = marts.customer_clv(facts.customer_profile(orders([order(f"o{n}", user=f"u{n}") for n in range(7)]), DAY))
    tiles = {row["USER_ID"]: row["CLV_QUINTILE"] for row in seven.collect()}
    assert tiles == {"u0": 1, "u1": 1, "u2": 2, "u3": 2, "u4": 3, "u5": 4, "u6": 5}


def test_rfm_scores_of_absent_and_negative_customers(orders):
    rows = [order("a", user="old", time="2023-01-01 00:00:00"), order("b", user="minus", time=days_ago(3), revenue="-5.00")]
    rows += [order(f"v{n}", user="vip", time=days_ago(n)) for n in range(3)]
    found = by(marts.customer_rfm(facts.customer_profile(orders(rows), DAY)), "USER_ID")
    scores = {user: (row["R_SCORE"], row["F_SCORE"], row["M_SCORE"], row["RFM_SEGMENT"]) for user, row in found.items()}
    assert scores == {
        "old": (2, 1, 1, "CHURN_RISK"), "minus": (4, 3, 1, "OTHER"), "vip": (5, 5, 5, "VIP")
    }


def test_restaurant_spans_count_empty_days_and_weeks(orders):
    rows = [
        order("a", time="2024-05-05 23:00:00"),
        order("b", time="2024-05-06 01:00:00", user=None),
        order("c", restaurant="R2", user=None, revenue="20.00"),
        order("d", restaurant="R3", revenue="20.00", user="  "),
    ]
    found = by(marts.restaurant_performance(orders(rows)), "RESTAURANT_ID")
    first = found["R1"]
    assert (first["ACTIVE_CALENDAR_DAYS"], first["ACTIVE_CALENDAR_WEEKS"]) == (2, 2)
    assert first["FIRST_WEEK_START"] == date(2024, 4, 29)
    assert first["AVG_DAILY_ORDERS"] == Decimal("1.0000")
    assert (found["R2"]["USER_COUNT"], found["R2"]["REVENUE_PER_USER"]) == (0, None)
    assert found["R3"]["USER_COUNT"] == 1
    assert {row["REVENUE_RANK"] for row in found.values()} == {1}


def test_trends_reconcile_and_start_on_monday(data):
    items = [item(order=f"O{n}", time=f"2024-05-{n:02d} 12:00:00", price=float(n)) for n in range(1, 20)]
    built = data(items)
    weekly = by(built.sales_trends_weekly, "PERIOD_START_DATE")
    assert {day.weekday() for day in weekly} == {0}
    totals = [
        sum(row["TOTAL_REVENUE"] for row in trend.collect())
        for trend in (built.sales_trends_daily, built.sales_trends_weekly, built.sales_trends_monthly)
    ]
    assert totals == [Decimal("190.00")] * 3
    assert [row["ORDER_COUNT"] for row in built.sales_trends_monthly.collect()] == [19]


def test_orphan_options_are_reported_and_ignored(data):
    built = data([item()], [option(order="O9")])
    assert facts.orphan_options(built.items, built.options).count() == 1
    assert built.lines.collect()[0]["OPTION_COUNT"] is None


def test_line_sales_use_the_time_of_the_order(data):
    built = data([item(time="2024-05-02 01:00:00"), item(line="L2", time="2024-05-01 23:00:00")])
    days = {row["ORDER_DATE"] for row in facts.line_sales_fact(built.lines, built.orders).collect()}
    assert days == {date(2024, 5, 1)}


def test_lines_and_options_travel_once_before_the_sums_per_order(spark, frame):
    """Two shuffles to the lines with their options, and one of sums per slice to their order; no fourth."""
    from order_analytics import session

    items = frame([item(line=f"L{number}", category=f"c{number % 3}") for number in range(12)], ITEM_SCHEMA)
    options = frame([option(line="L1", price=0), option(line="L2", price=3, quantity=2)], OPTION_SCHEMA)
    with session.joined_as_placed(spark):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            plan = facts.order_category_fact(facts.sliced_line_fact(items, options))._jdf.queryExecution().executedPlan().toString()
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning(") == 3


def test_sums_by_slice_equal_sums_by_line(spark, frame):
    """Null, repeated and hot keys included."""
    rows = [item(line=f"L{number}", category=None if number % 5 == 0 else f"c{number % 3}", price=float(number), user=None) for number in range(300)]
    rows += [item(order="O2", line=None), item(order=None, line="L1"), item(order="O3"), item(order="O3"), item(order="O4", restaurant="R2", loyalty="TRUE")]
    items = frame(rows, ITEM_SCHEMA)
    options = frame([option(line=f"L{number}", price=number % 4) for number in range(0, 300, 2)] + [option(order="O3", price=2), option(order="O2", line=None)], OPTION_SCHEMA)
    by_line = facts.order_category_fact(facts.line_fact(items, options))
    by_slice = facts.order_category_fact(facts.sliced_line_fact(items, options))
    assert sorted(map(str, by_slice.collect())) == sorted(map(str, by_line.collect()))
    assert by_slice.columns == by_line.columns


def test_whole_orders_travel_once_and_sliced_ones_give_the_same(spark, frame, monkeypatch):
    """Two shuffles, of lines and of options, where no order is sliced; null, repeated and hot keys included."""
    from order_analytics import session

    rows = [item(line=f"L{number}", category=None if number % 5 == 0 else f"c{number % 3}", price=float(number), user=None) for number in range(300)]
    rows += [item(order="O2", line=None), item(order=None, line="L1"), item(order="O3"), item(order="O3"), item(order="O4", restaurant="R2", loyalty="TRUE")]
    items = frame(rows, ITEM_SCHEMA)
    options = frame([option(line=f"L{number}", price=number % 4) for number in range(0, 300, 2)] + [option(order="O3", price=2), option(order="O2", line=None)], OPTION_SCHEMA)
    by_line = facts.order_category_fact(facts.line_fact(items, options))
    expected = sorted(map(str, by_line.collect()))
    assert facts.sliced_orders(items) == []
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with session.joined_as_placed(spark):
            whole = facts.order_categories(items, options, [])
            assert whole._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning(") == 2
            assert sorted(map(str, whole.collect())) == expected and whole.columns == by_line.columns
            monkeypatch.setattr(facts, "SLICED_LINES", 2)
            sliced = facts.sliced_orders(items)
            assert len(sliced) == 2  # the hot one and the one with a repeated line
            assert sorted(map(str, facts.order_categories(items, options, sliced).collect())) == expected
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def placed_rows():
    items = [item(order=f"O{k % 40}", line=f"L{k}", restaurant=f"R{k % 3}", time=f"2024-05-{1 + k % 28:02d} 10:00:00", category=f"c{k % 4}") for k in range(400)]
    items += [item(order="hot", line=f"L{k}", category=None, quantity=None) for k in range(300)] + [item(order=None, line="L1"), item(line=None)]
    options = [option(order=f"O{k % 40}", line=f"L{k}", price=k % 5) for k in range(0, 400, 3)] + [option(order="hot", line="L7", price=9)] * 2
    return items, options


def test_dated_lines_travel_once(spark, data, monkeypatch):
    """Lines are placed by order once for their orders' figures and their own dates; only orders travel to them."""
    monkeypatch.setattr(facts, "BUCKET_LINES", 1000)
    names = ("ORDER_ID", "LINEITEM_ID", "RESTAURANT_ID", "ITEM_CATEGORY", "LINE_REVENUE", "ORDER_TIMESTAMP", "ORDER_DATE")
    plain = data(*placed_rows())
    expected = sorted(map(str, facts.line_sales_fact(plain.lines, plain.orders).select(*names).collect()))
    categories = sorted(map(str, plain.order_categories.collect()))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for least, apart in ((1000, 0), (200, 1)):
            monkeypatch.setattr(facts, "BUCKET_LINES", least)
            built = data(*placed_rows())
            plan = built.line_sales.select(*names)._jdf.queryExecution().executedPlan().toString()
            assert len(built.placed_lines.apart) == apart
            if not apart:
                assert plan.count("Exchange hashpartitioning(") == 1 and "Bucketed: true" in plan
            assert sorted(map(str, built.line_sales.select(*names).collect())) == expected
            assert sorted(map(str, built.order_categories.collect())) == categories
            built.release()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_an_order_beyond_the_share_of_a_bucket_is_apart(frame, monkeypatch):
    monkeypatch.setattr(facts, "BUCKET_LINES", 5)
    items = frame([item(order="big", line=f"L{k}") for k in range(30)] + [item(order=f"O{k}") for k in range(90)], ITEM_SCHEMA)
    assert len(facts.sliced_orders(items, 8)) == 1  # 120 / 8 lines are a share
    assert facts.sliced_orders(items, 2) == facts.sliced_orders(items) == []
