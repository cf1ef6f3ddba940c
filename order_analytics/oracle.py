"""Independent SQL (DuckDB dialect) for the registered queries, used to check their results.

Money is kept in whole cents; ratios round half up on integers, so no binary fraction is involved.
"""

from __future__ import annotations

import re

CREATED = "o_orderdate + to_minutes(l_orderkey % 1440) + to_seconds(l_linenumber)"
LINE_ID = (
    "'L' || l_linenumber || '-' || l_partkey || '-' || l_suppkey || '-'"
    " || date_diff('day', DATE '1970-01-01', CAST(l_shipdate AS DATE))"
)
FLOAT_CENTS = "CAST(round(CAST(CAST(l_extendedprice AS FLOAT) AS DOUBLE) * 100) AS BIGINT)"
SEVERAL = "ITEM_CATEGORY IN ('ECONOMY', 'SMALL', 'UNKNOWN')"
CHOSEN_DAYS = "PERIOD_START_DATE BETWEEN DATE '1996-01-01' AND DATE '2000-12-31'"


def half_up(part: str, whole: str) -> str:
    """part / whole rounded half up, on integers; whole is positive."""
    return f"CAST(sign({part}) * ((2 * abs({part}) + ({whole})) // (2 * ({whole}))) AS BIGINT)"


def scaled(units: str, scale: int, precision: int = 30) -> str:
    step = "0." + "0" * (scale - 1) + "1"
    return f"CAST(CAST({units} AS BIGINT) * CAST({step} AS DECIMAL({scale + 1},{scale})) AS DECIMAL({precision},{scale}))"


def money(cents: str, precision: int = 30) -> str:
    return scaled(cents, 2, precision)


def count_of(text: str) -> str:
    return f"CAST({text} AS BIGINT)"


ITEM_COLUMNS = f"""
    'APP' AS APP_NAME,
    'R' || lpad(CAST(l_suppkey % 5 + 5 * (l_orderkey % 8) AS VARCHAR), 3, '0') AS RESTAURANT_ID,
    {CREATED} AS CREATION_TIME_UTC,
    'O' || l_orderkey AS ORDER_ID,
    CASE WHEN o_custkey % 50 = 0 THEN NULL WHEN o_custkey % 50 = 1 THEN '   '
         WHEN o_custkey % 50 = 2 THEN ' C' || o_custkey || ' ' ELSE 'C' || o_custkey END AS USER_ID,
    CAST(NULL AS VARCHAR) AS PRINTED_CARD_NUMBER,
    CASE o_orderstatus WHEN 'F' THEN 'TRUE' WHEN 'O' THEN ' false ' END AS IS_LOYALTY,
    'USD' AS CURRENCY,
    {LINE_ID} AS LINEITEM_ID,
    'L' || l_linenumber AS COARSE_LINE,
    CASE WHEN p_size = 50 THEN NULL ELSE p_type END AS ITEM_CATEGORY,
    p_name AS ITEM_NAME,
    {FLOAT_CENTS} AS PRICE_CENTS,
    CASE WHEN l_linenumber = 7 THEN NULL ELSE CAST(l_quantity AS INT) END AS ITEM_QUANTITY,
    CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 0 END AS LOYALTY_FLAG,
    o_orderdate, o_orderstatus, o_custkey, l_linestatus, l_returnflag, l_quantity, l_tax, l_discount, l_extendedprice
"""

PARTS = {
    "items": f"""
SELECT {ITEM_COLUMNS} FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey""",
    "options": f"""
SELECT 'O' || l_orderkey AS ORDER_ID, {LINE_ID} AS LINEITEM_ID, 'SIZE' AS OPTION_GROUP_NAME,
  l_returnflag AS OPTION_NAME, CAST(round(l_tax * 100) AS DECIMAL(18,0)) AS OPTION_PRICE,
  CAST(l_linenumber AS DECIMAL(18,0)) AS OPTION_QUANTITY FROM lineitem WHERE l_tax > 0
UNION ALL
SELECT 'O' || l_orderkey, {LINE_ID}, 'PROMO', l_linestatus, CAST(round(l_discount * 100) AS DECIMAL(18,0)),
  CAST(1 AS DECIMAL(18,0)) FROM lineitem WHERE l_quantity <= 10""",
    "option_sums": """
SELECT ORDER_ID, LINEITEM_ID, sum(CAST(OPTION_PRICE AS BIGINT) * CAST(OPTION_QUANTITY AS BIGINT) * 100) AS OPTION_CENTS,
  max(CASE WHEN OPTION_PRICE = 0 THEN 1 ELSE 0 END) AS HAS_ZERO_PRICE_OPTION, count(*) AS OPTION_COUNT
FROM options GROUP BY ALL""",
    "lines": """
SELECT i.*, CAST(coalesce(OPTION_CENTS, 0) AS BIGINT) AS OPTION_CENTS,
  coalesce(HAS_ZERO_PRICE_OPTION, 0) AS HAS_ZERO_PRICE_OPTION, OPTION_COUNT,
  CAST(PRICE_CENTS + coalesce(OPTION_CENTS, 0) AS BIGINT) AS LINE_CENTS
FROM items i LEFT JOIN option_sums s ON i.ORDER_ID = s.ORDER_ID AND i.LINEITEM_ID = s.LINEITEM_ID""",
    "order_rows": """
SELECT ORDER_ID, RESTAURANT_ID, min(USER_ID) AS USER_ID, min(LOYALTY_FLAG) AS LOYALTY_FLAG,
  min(CREATION_TIME_UTC) AS ORDER_TIMESTAMP, CAST(sum(LINE_CENTS) AS BIGINT) AS ORDER_CENTS,
  max(HAS_ZERO_PRICE_OPTION) AS HAS_DISCOUNT, CAST(sum(coalesce(ITEM_QUANTITY, 0)) AS BIGINT) AS TOTAL_ITEM_QUANTITY,
  CAST(min(CREATION_TIME_UTC) AS DATE) AS ORDER_DATE
FROM lines GROUP BY ORDER_ID, RESTAURANT_ID""",
    "buyer_orders": """
SELECT * REPLACE (trim(USER_ID) AS USER_ID) FROM order_rows WHERE length(trim(USER_ID)) > 0""",
    "last_day": "SELECT max(ORDER_DATE) AS AD FROM order_rows",
    "buyers": f"""
SELECT USER_ID, CAST(sum(ORDER_CENTS) AS BIGINT) AS LIFETIME_CENTS, count(*) AS LIFETIME_ORDER_COUNT,
  min(ORDER_DATE) AS FIRST_ORDER_DATE, max(ORDER_DATE) AS LAST_ORDER_DATE,
  {half_up('CAST(sum(ORDER_CENTS) AS BIGINT)', 'count(*)')} AS AVG_CENTS
FROM buyer_orders GROUP BY USER_ID""",
    "recent": """
SELECT USER_ID, count(*) AS FREQUENCY_6M, CAST(sum(ORDER_CENTS) AS BIGINT) AS MONETARY_CENTS
FROM buyer_orders, last_day WHERE ORDER_DATE >= AD - INTERVAL 6 MONTH AND ORDER_DATE <= AD GROUP BY USER_ID""",
    "gaps": """
SELECT *, lag(ORDER_DATE) OVER (PARTITION BY USER_ID ORDER BY ORDER_TIMESTAMP, ORDER_ID, RESTAURANT_ID)
  AS PREVIOUS_ORDER_DATE FROM buyer_orders""",
    "mean_gaps": """
SELECT USER_ID, avg(date_diff('day', PREVIOUS_ORDER_DATE, ORDER_DATE)) AS AVG_DAYS_BETWEEN_ORDERS
FROM gaps GROUP BY USER_ID""",
    "spend": """
SELECT USER_ID,
  CAST(sum(CASE WHEN date_diff('day', ORDER_DATE, AD) BETWEEN 0 AND 29 THEN ORDER_CENTS ELSE 0 END) AS BIGINT) AS CURRENT_CENTS,
  CAST(sum(CASE WHEN date_diff('day', ORDER_DATE, AD) BETWEEN 30 AND 59 THEN ORDER_CENTS ELSE 0 END) AS BIGINT) AS PREVIOUS_CENTS
FROM buyer_orders, last_day GROUP BY USER_ID""",
    "latest": """
SELECT USER_ID, LOYALTY_FLAG AS LATEST_LOYALTY_FLAG FROM buyer_orders
QUALIFY row_number() OVER (PARTITION BY USER_ID ORDER BY ORDER_TIMESTAMP DESC, ORDER_ID DESC, RESTAURANT_ID DESC) = 1""",
    "clv": """
SELECT *, CASE CLV_QUINTILE WHEN 5 THEN 'HIGH' WHEN 1 THEN 'LOW' ELSE 'MEDIUM' END AS CLV_SEGMENT FROM (
  SELECT *, CAST(ntile(5) OVER (ORDER BY LIFETIME_CENTS, USER_ID) AS INT) AS CLV_QUINTILE FROM buyers)""",
    "rfm_values": """
SELECT b.USER_ID, LAST_ORDER_DATE, coalesce(FREQUENCY_6M, 0) AS FREQUENCY_6M,
  coalesce(MONETARY_CENTS, 0) AS MONETARY_CENTS, CAST(date_diff('day', LAST_ORDER_DATE, AD) AS INT) AS RECENCY_DAYS
FROM buyers b CROSS JOIN last_day LEFT JOIN recent r ON b.USER_ID = r.USER_ID""",
    "rfm_places": """
SELECT *, count(*) OVER () AS N, count(*) OVER (ORDER BY RECENCY_DAYS DESC) AS R_PLACE,
  count(*) FILTER (FREQUENCY_6M > 0) OVER () AS F_N, count(*) FILTER (FREQUENCY_6M > 0) OVER (ORDER BY FREQUENCY_6M) AS F_PLACE,
  count(*) FILTER (MONETARY_CENTS > 0) OVER () AS M_N, count(*) FILTER (MONETARY_CENTS > 0) OVER (ORDER BY MONETARY_CENTS) AS M_PLACE
FROM rfm_values""",
    "rfm_scores": """
SELECT USER_ID, LAST_ORDER_DATE, FREQUENCY_6M, MONETARY_CENTS, RECENCY_DAYS,
  CAST(least(5, greatest(1, (5 * R_PLACE + N - 1) // N)) AS INT) AS R_SCORE,
  CAST(CASE WHEN FREQUENCY_6M > 0 THEN 1 + (4 * F_PLACE + F_N - 1) // F_N ELSE 1 END AS INT) AS F_SCORE,
  CAST(CASE WHEN MONETARY_CENTS > 0 THEN 1 + (4 * M_PLACE + M_N - 1) // M_N ELSE 1 END AS INT) AS M_SCORE
FROM rfm_places""",
    "rfm": """
SELECT *, CASE WHEN R_SCORE >= 4 AND F_SCORE >= 4 AND M_SCORE >= 4 AND R_SCORE + F_SCORE + M_SCORE >= 14 THEN 'VIP'
  WHEN R_SCORE >= 4 AND F_SCORE <= 2 THEN 'NEW_CUSTOMER' WHEN R_SCORE <= 2 AND F_SCORE <= 2 THEN 'CHURN_RISK'
  ELSE 'OTHER' END AS RFM_SEGMENT FROM rfm_scores""",
    "churn": f"""
SELECT b.USER_ID, LAST_ORDER_DATE, LIFETIME_ORDER_COUNT, AVG_DAYS_BETWEEN_ORDERS,
  {money('CURRENT_CENTS')} AS CURRENT_30_DAY_SPEND, {money('PREVIOUS_CENTS')} AS PREVIOUS_30_DAY_SPEND,
  CAST(date_diff('day', LAST_ORDER_DATE, AD) AS INT) AS DAYS_SINCE_LAST_ORDER,
  CASE WHEN PREVIOUS_CENTS <> 0 THEN
    {money(half_up(half_up('(CURRENT_CENTS - PREVIOUS_CENTS) * 10000000', 'PREVIOUS_CENTS'), '1000'), 12)} END AS SPEND_CHANGE_PCT,
  CASE WHEN date_diff('day', LAST_ORDER_DATE, AD) > 45 THEN 'AT_RISK' ELSE 'NOT_AT_RISK' END AS CHURN_STATUS
FROM buyers b CROSS JOIN last_day JOIN mean_gaps g ON b.USER_ID = g.USER_ID JOIN spend s ON b.USER_ID = s.USER_ID""",
    "sales": """
SELECT l.*, ORDER_TIMESTAMP, ORDER_DATE FROM lines l JOIN order_rows o
ON l.ORDER_ID = o.ORDER_ID AND l.RESTAURANT_ID = o.RESTAURANT_ID""",
}


def _trend(period: str) -> str:
    return f"""
SELECT {period} AS PERIOD_START_DATE, RESTAURANT_ID, ITEM_CATEGORY, CAST(sum(LINE_CENTS) AS BIGINT) AS CENTS,
  count(DISTINCT (ORDER_ID, RESTAURANT_ID)) AS ORDER_COUNT,
  CAST(sum(coalesce(ITEM_QUANTITY, 0)) AS BIGINT) AS ITEM_QUANTITY
FROM sales GROUP BY ALL"""


PARTS |= {
    "daily": _trend("ORDER_DATE"),
    "weekly": _trend("CAST(date_trunc('week', ORDER_TIMESTAMP) AS DATE)"),
    "monthly": _trend("CAST(date_trunc('month', ORDER_DATE) AS DATE)"),
    "daily_named": "SELECT * REPLACE (coalesce(ITEM_CATEGORY, 'UNKNOWN') AS ITEM_CATEGORY) FROM daily",
    "members": """
SELECT b.*, LATEST_LOYALTY_FLAG,
  CASE WHEN LATEST_LOYALTY_FLAG = 1 THEN 'LOYALTY_MEMBER' ELSE 'NON_MEMBER' END AS LOYALTY_STATUS,
  CASE WHEN LIFETIME_ORDER_COUNT > 1 THEN 1 ELSE 0 END AS IS_REPEAT_USER
FROM buyers b JOIN latest l ON b.USER_ID = l.USER_ID""",
    "loyalty_sums": """
SELECT LOYALTY_STATUS, count(*) AS USER_COUNT, CAST(sum(LIFETIME_ORDER_COUNT) AS BIGINT) AS ORDER_COUNT,
  CAST(sum(LIFETIME_CENTS) AS BIGINT) AS CENTS, CAST(sum(IS_REPEAT_USER) AS BIGINT) AS REPEAT_USER_COUNT
FROM members GROUP BY LOYALTY_STATUS""",
    "loyalty": f"""
SELECT LOYALTY_STATUS, USER_COUNT, ORDER_COUNT, {money('CENTS')} AS TOTAL_REVENUE,
  {money(half_up('CENTS', 'USER_COUNT'))} AS AVG_LIFETIME_REVENUE_PER_USER, REPEAT_USER_COUNT,
  {money(half_up('CENTS', 'ORDER_COUNT'))} AS AVG_ORDER_VALUE,
  {money(half_up('REPEAT_USER_COUNT * 10000', 'USER_COUNT'), 10)} AS REPEAT_USER_RATE_PCT
FROM loyalty_sums""",
    "restaurant_sums": """
SELECT RESTAURANT_ID, CAST(sum(ORDER_CENTS) AS BIGINT) AS CENTS, count(*) AS ORDER_COUNT,
  count(DISTINCT USER_ID) AS USER_COUNT, min(ORDER_DATE) AS FIRST_ORDER_DATE, max(ORDER_DATE) AS LAST_ORDER_DATE,
  CAST(date_trunc('week', min(ORDER_DATE)) AS DATE) AS FIRST_WEEK_START,
  CAST(date_trunc('week', max(ORDER_DATE)) AS DATE) AS LAST_WEEK_START
FROM order_rows GROUP BY RESTAURANT_ID""",
    "restaurant_spans": """
SELECT *, CAST(date_diff('day', FIRST_ORDER_DATE, LAST_ORDER_DATE) + 1 AS INT) AS ACTIVE_CALENDAR_DAYS,
  CAST(date_diff('day', FIRST_WEEK_START, LAST_WEEK_START) // 7 + 1 AS INT) AS ACTIVE_CALENDAR_WEEKS
FROM restaurant_sums""",
    "restaurants": f"""
SELECT RESTAURANT_ID, {money('CENTS')} AS TOTAL_REVENUE, ORDER_COUNT, USER_COUNT, FIRST_ORDER_DATE, LAST_ORDER_DATE,
  ACTIVE_CALENDAR_DAYS, FIRST_WEEK_START, LAST_WEEK_START, ACTIVE_CALENDAR_WEEKS,
  {money(half_up('CENTS', 'ORDER_COUNT'))} AS AVERAGE_ORDER_VALUE,
  CASE WHEN USER_COUNT > 0 THEN {money(half_up('CENTS', 'greatest(USER_COUNT, 1)'))} END AS REVENUE_PER_USER,
  {scaled(half_up('ORDER_COUNT * 10000', 'ACTIVE_CALENDAR_DAYS'), 4, 18)} AS AVG_DAILY_ORDERS,
  {scaled(half_up('ORDER_COUNT * 10000', 'ACTIVE_CALENDAR_WEEKS'), 4, 18)} AS AVG_WEEKLY_ORDERS,
  CAST(dense_rank() OVER (ORDER BY CENTS DESC) AS INT) AS REVENUE_RANK
FROM restaurant_spans""",
    "restaurant_names": """
SELECT *, CASE WHEN length(RESTAURANT_ID) <= 3 THEN RESTAURANT_ID ELSE '...' || right(RESTAURANT_ID, 3) END
  AS RESTAURANT_ID_DISPLAY FROM restaurants""",
    "discount_sums": """
SELECT CASE WHEN HAS_DISCOUNT = 1 THEN 'DISCOUNTED' ELSE 'NON_DISCOUNTED' END AS DISCOUNT_STATUS,
  count(*) AS ORDER_COUNT, CAST(sum(ORDER_CENTS) AS BIGINT) AS CENTS, count(DISTINCT USER_ID) AS USER_COUNT
FROM order_rows GROUP BY 1""",
    "ranked_clv": "SELECT LIFETIME_CENTS, row_number() OVER (ORDER BY LIFETIME_CENTS) AS PLACE, count(*) OVER () AS N FROM buyers",
    "percentiles": """
SELECT P, max(CASE WHEN PLACE = (N - 1) * P // 100 + 1 THEN LIFETIME_CENTS END) * 100
  + (max(CASE WHEN PLACE = least(N, (N - 1) * P // 100 + 2) THEN LIFETIME_CENTS END)
     - max(CASE WHEN PLACE = (N - 1) * P // 100 + 1 THEN LIFETIME_CENTS END)) * (max(N - 1) * P % 100) AS E4
FROM ranked_clv CROSS JOIN (VALUES (50), (90), (95), (99)) v(P) GROUP BY P""",
    "histogram_rows": """
SELECT LIFETIME_CENTS / 100 AS V FROM buyers
WHERE LIFETIME_CENTS * 100 <= (SELECT E4 FROM percentiles WHERE P = 99)""",
    "flawed": f"""
SELECT CASE WHEN l_quantity = 49 THEN NULL ELSE ORDER_ID END AS ORDER_ID, RESTAURANT_ID, COARSE_LINE AS LINEITEM_ID,
  CASE WHEN l_tax = 0 AND l_linestatus = 'O' THEN NULL ELSE CREATION_TIME_UTC END AS CREATION_TIME_UTC,
  CASE WHEN l_returnflag = 'R' THEN 'GUEST' ELSE 'C' || o_custkey END AS USER_ID,
  CASE WHEN o_orderstatus = 'P' THEN 'PENDING' WHEN o_orderstatus = 'F' THEN 'TRUE' WHEN l_linestatus = 'O' THEN 'False' END AS IS_LOYALTY,
  CASE WHEN o_orderstatus = 'F' THEN 1 WHEN o_orderstatus <> 'P' AND l_linestatus = 'O' THEN 0 END AS LOYALTY_FLAG,
  CASE WHEN l_discount = 0.1 THEN NULL ELSE l_extendedprice END AS ITEM_PRICE, ITEM_NAME,
  CASE WHEN l_quantity = 50 THEN NULL ELSE CAST(l_quantity AS INT) END AS ITEM_QUANTITY
FROM items""",
    "flawed_options": """
SELECT CASE WHEN OPTION_PRICE <> 7 THEN ORDER_ID END AS ORDER_ID, split_part(LINEITEM_ID, '-', 1) AS LINEITEM_ID,
  OPTION_GROUP_NAME, OPTION_NAME, CASE WHEN OPTION_PRICE <> 5 THEN OPTION_PRICE END AS OPTION_PRICE,
  CASE WHEN OPTION_QUANTITY <> 3 THEN OPTION_QUANTITY END AS OPTION_QUANTITY FROM options""",
    "option_conflicts": """
SELECT ORDER_ID, LINEITEM_ID, OPTION_GROUP_NAME, OPTION_NAME FROM (SELECT DISTINCT * FROM flawed_options)
GROUP BY ALL HAVING count(*) > 1""",
    "flawed_days": """
SELECT CASE WHEN NOT (month(DATE_KEY) = 3 AND dayname(DATE_KEY) = 'Sunday') THEN DATE_KEY END AS DATE_KEY,
  year(DATE_KEY) AS Y, month(DATE_KEY) AS M, week(DATE_KEY) AS W FROM days""",
    "coarse": """
SELECT DISTINCT APP_NAME, ORDER_ID, COARSE_LINE AS LINEITEM_ID, RESTAURANT_ID, CREATION_TIME_UTC, USER_ID, IS_LOYALTY,
  ITEM_CATEGORY, ITEM_NAME, PRICE_CENTS, ITEM_QUANTITY FROM items""",
    "coarse_conflicts": """
SELECT ORDER_ID, LINEITEM_ID, RESTAURANT_ID, CREATION_TIME_UTC FROM coarse GROUP BY ALL HAVING count(*) > 1""",
    "older": "SELECT *, CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END AS OTHER_PRICE FROM items WHERE o_orderdate < DATE '2001-01-01'",
    "newer": "SELECT *, 0 AS OTHER_PRICE FROM items WHERE l_returnflag <> 'R'",
    "changes": """
SELECT coalesce(t.ORDER_ID, s.ORDER_ID) AS ORDER_ID, coalesce(t.LINEITEM_ID, s.LINEITEM_ID) AS LINEITEM_ID,
  coalesce(t.RESTAURANT_ID, s.RESTAURANT_ID) AS RESTAURANT_ID,
  coalesce(t.CREATION_TIME_UTC, s.CREATION_TIME_UTC) AS CREATION_TIME_UTC,
  CASE WHEN t.ORDER_ID IS NULL THEN 'INSERT' WHEN s.ORDER_ID IS NULL THEN 'DELETE'
       WHEN t.OTHER_PRICE = 1 THEN 'UPDATE' ELSE 'UNCHANGED' END AS ACTION
FROM older t FULL JOIN newer s ON t.ORDER_ID = s.ORDER_ID AND t.LINEITEM_ID = s.LINEITEM_ID
  AND t.RESTAURANT_ID = s.RESTAURANT_ID AND t.CREATION_TIME_UTC = s.CREATION_TIME_UTC""",
    "week_before": "SELECT * FROM items WHERE NOT o_orderdate >= DATE '2001-07-25'",
    "week_after": "SELECT * FROM items WHERE NOT (o_orderdate >= DATE '2001-07-01' AND l_returnflag = 'R')",
    "week_changes": """
SELECT *, (year(CREATION_TIME_UTC) * 12 + month(CREATION_TIME_UTC)) * 4
  + CAST('0x' || left(md5(concat_ws('|', ORDER_ID, LINEITEM_ID, RESTAURANT_ID, CAST(CREATION_TIME_UTC AS VARCHAR))), 7) AS BIGINT) % 4 AS BUCKET
FROM (
  SELECT coalesce(t.ORDER_ID, s.ORDER_ID) AS ORDER_ID, coalesce(t.LINEITEM_ID, s.LINEITEM_ID) AS LINEITEM_ID,
    coalesce(t.RESTAURANT_ID, s.RESTAURANT_ID) AS RESTAURANT_ID, coalesce(t.CREATION_TIME_UTC, s.CREATION_TIME_UTC) AS CREATION_TIME_UTC,
    CASE WHEN t.ORDER_ID IS NULL THEN 'INSERT' WHEN s.ORDER_ID IS NULL THEN 'DELETE'
         WHEN s.o_orderdate >= DATE '2001-07-01' AND s.l_linestatus = 'O' THEN 'UPDATE' ELSE 'UNCHANGED' END AS ACTION
  FROM week_before t FULL JOIN week_after s ON t.ORDER_ID = s.ORDER_ID AND t.LINEITEM_ID = s.LINEITEM_ID
    AND t.RESTAURANT_ID = s.RESTAURANT_ID AND t.CREATION_TIME_UTC = s.CREATION_TIME_UTC)""",
    "days": """
SELECT CAST(unnest(generate_series(CAST(min(o_orderdate) AS DATE), CAST(max(o_orderdate) AS DATE), INTERVAL 1 DAY)) AS DATE)
  AS DATE_KEY FROM orders""",
}

PARTS |= {
    "table_sizes": """
SELECT 'date_dim' AS T, count(*) AS N FROM days UNION ALL SELECT 'order_item_options', count(*) FROM options
UNION ALL SELECT 'order_items', count(*) FROM items""",
    "mart_sizes": """
SELECT 'customer_clv' AS T, count(*) AS N FROM buyers UNION ALL SELECT 'customer_rfm', count(*) FROM buyers
UNION ALL SELECT 'churn_indicators', count(*) FROM buyers UNION ALL SELECT 'sales_trends_daily', count(*) FROM daily
UNION ALL SELECT 'sales_trends_weekly', count(*) FROM weekly UNION ALL SELECT 'sales_trends_monthly', count(*) FROM monthly
UNION ALL SELECT 'loyalty_program_impact', count(*) FROM loyalty UNION ALL SELECT 'restaurant_performance', count(*) FROM restaurants
UNION ALL SELECT 'discount_effectiveness', count(*) FROM discount_sums""",
}

LIFETIME = f"""{money('LIFETIME_CENTS')} AS LIFETIME_REVENUE, LIFETIME_ORDER_COUNT, FIRST_ORDER_DATE, LAST_ORDER_DATE,
  {money('AVG_CENTS')} AS LIFETIME_AVG_ORDER_VALUE"""
LINEAGE = "TIMESTAMP '2026-01-01 00:00:00' AS _INGESTED_AT, '{}' AS _SOURCE_TABLE, 'FULL_DAILY' AS _LOAD_TYPE"
MART_TREND = f"""SELECT PERIOD_START_DATE, RESTAURANT_ID, ITEM_CATEGORY, {money('CENTS')} AS TOTAL_REVENUE, ORDER_COUNT,
  ITEM_QUANTITY, {money(half_up('CENTS', 'ORDER_COUNT'))} AS AVERAGE_ORDER_VALUE FROM """
TREND_KEY = "concat_ws('|', CAST(PERIOD_START_DATE AS VARCHAR), RESTAURANT_ID, coalesce(ITEM_CATEGORY, ''))"
SUM_REVENUE = f"{money('sum(CENTS)')} AS TOTAL_REVENUE"
RFM_COLUMNS = f"""USER_ID, LAST_ORDER_DATE, FREQUENCY_6M, {money('MONETARY_CENTS')} AS MONETARY_6M, RECENCY_DAYS,
  R_SCORE, F_SCORE, M_SCORE, RFM_SEGMENT"""
MEMBER_SHARE = """100 * coalesce(sum(USER_COUNT) FILTER (LOYALTY_STATUS = 'LOYALTY_MEMBER'), 0) / sum(USER_COUNT)"""
DISCOUNT_SHARE = """100 * coalesce(sum(ORDER_COUNT) FILTER (DISCOUNT_STATUS = 'DISCOUNTED'), 0) / sum(ORDER_COUNT)"""
AVG_REVENUE = scaled(half_up("CAST(sum({0}) AS BIGINT) * 10000", "count(*)"), 6, 34)

QUERIES = {
    "option_fact": f"""SELECT ORDER_ID, LINEITEM_ID, {money('OPTION_CENTS', 24)} AS OPTION_REVENUE, HAS_ZERO_PRICE_OPTION,
  OPTION_COUNT FROM option_sums""",
    "line_fact": f"""SELECT ORDER_ID, LINEITEM_ID, RESTAURANT_ID, CREATION_TIME_UTC, USER_ID, LOYALTY_FLAG, ITEM_CATEGORY,
  ITEM_NAME, ITEM_QUANTITY, {money('OPTION_CENTS', 24)} AS OPTION_REVENUE, HAS_ZERO_PRICE_OPTION, OPTION_COUNT,
  {money('LINE_CENTS', 24)} AS LINE_REVENUE FROM lines""",
    "order_fact": f"""SELECT ORDER_ID, RESTAURANT_ID, USER_ID, LOYALTY_FLAG, ORDER_TIMESTAMP,
  {money('ORDER_CENTS')} AS ORDER_REVENUE, HAS_DISCOUNT, TOTAL_ITEM_QUANTITY, ORDER_DATE FROM order_rows""",
    "customer_orders": f"""SELECT ORDER_ID, RESTAURANT_ID, USER_ID, LOYALTY_FLAG, ORDER_TIMESTAMP,
  {money('ORDER_CENTS')} AS ORDER_REVENUE, HAS_DISCOUNT, TOTAL_ITEM_QUANTITY, ORDER_DATE FROM buyer_orders""",
    "customer_base": f"SELECT USER_ID, {LIFETIME} FROM buyers",
    "analysis_date": "SELECT AD AS ANALYSIS_DATE FROM last_day",
    "line_sales_fact": f"""SELECT ORDER_ID, LINEITEM_ID, RESTAURANT_ID, ITEM_CATEGORY,
  {money('LINE_CENTS', 24)} AS LINE_REVENUE, ORDER_TIMESTAMP, ORDER_DATE FROM sales""",
    "loyalty_normalized": "SELECT ORDER_ID, LINEITEM_ID, IS_LOYALTY, LOYALTY_FLAG FROM items",
    "six_month_metrics": f"SELECT USER_ID, FREQUENCY_6M, {money('MONETARY_CENTS')} AS MONETARY_6M FROM recent",
    "order_gaps": """SELECT USER_ID, ORDER_ID, RESTAURANT_ID, ORDER_TIMESTAMP, ORDER_DATE, PREVIOUS_ORDER_DATE,
  CAST(date_diff('day', PREVIOUS_ORDER_DATE, ORDER_DATE) AS INT) AS GAP_DAYS FROM gaps""",
    "average_gaps": "SELECT USER_ID, AVG_DAYS_BETWEEN_ORDERS FROM mean_gaps",
    "spend_periods": f"""SELECT USER_ID, {money('CURRENT_CENTS')} AS CURRENT_30_DAY_SPEND,
  {money('PREVIOUS_CENTS')} AS PREVIOUS_30_DAY_SPEND FROM spend""",
    "latest_customer_order": "SELECT USER_ID, LATEST_LOYALTY_FLAG FROM latest",
    "customer_loyalty_stats": f"""SELECT USER_ID, {LIFETIME}, LATEST_LOYALTY_FLAG, LOYALTY_STATUS, IS_REPEAT_USER
  FROM members""",
    "orphan_options": """SELECT * FROM options o WHERE NOT EXISTS (SELECT 1 FROM items i WHERE i.ORDER_ID = o.ORDER_ID
  AND i.LINEITEM_ID = o.LINEITEM_ID AND i.ITEM_CATEGORY IS NOT NULL)""",
    "customer_clv": f"SELECT USER_ID, {LIFETIME}, CLV_QUINTILE, CLV_SEGMENT FROM clv",
    "customer_rfm": f"SELECT {RFM_COLUMNS} FROM rfm",
    "churn_indicators": "SELECT * FROM churn",
    "sales_trends_daily": MART_TREND + "daily",
    "sales_trends_weekly": MART_TREND + "weekly",
    "sales_trends_monthly": MART_TREND + "monthly",
    "loyalty_program_impact": "SELECT * FROM loyalty",
    "restaurant_performance": "SELECT * FROM restaurants",
    "discount_effectiveness": f"""SELECT DISCOUNT_STATUS, ORDER_COUNT, {money('CENTS')} AS TOTAL_REVENUE, USER_COUNT,
  {money(half_up('CENTS', 'ORDER_COUNT'))} AS AVERAGE_ORDER_VALUE FROM discount_sums""",
    "gate_rfm_scores": """SELECT 'ZERO_FREQUENCY_SCORE' AS RULE, count(*) FILTER (FREQUENCY_6M = 0 AND F_SCORE + RECENCY_DAYS % 2 <> 1) AS VIOLATIONS FROM rfm
  UNION ALL SELECT 'ZERO_MONETARY_SCORE', count(*) FILTER (MONETARY_CENTS = 0 AND M_SCORE + RECENCY_DAYS % 2 <> 1) FROM rfm""",
    "gate_restaurant_spans": """SELECT 'DAY_SPAN_NOT_POSITIVE' AS RULE, count(*) FILTER (ORDER_COUNT % 2 = 1 OR ACTIVE_CALENDAR_DAYS <= 0) AS VIOLATIONS
  FROM restaurants UNION ALL SELECT 'WEEK_SPAN_NOT_POSITIVE', count(*) FILTER (ORDER_COUNT % 2 = 1 OR ACTIVE_CALENDAR_WEEKS <= 0) FROM restaurants""",
    "user_id_diagnostics": """SELECT count(*) FILTER (USER_ID IS NULL) AS NULL_USER_ORDERS,
  count(*) FILTER (USER_ID IS NOT NULL AND trim(USER_ID) = '') AS BLANK_USER_ORDERS,
  count(*) FILTER (trim(USER_ID) <> '') AS CUSTOMER_ORDERS,
  count(DISTINCT trim(USER_ID)) FILTER (trim(USER_ID) <> '') AS CUSTOMERS FROM order_rows""",
    "rfm_segment_counts": "SELECT RFM_SEGMENT, count(*) AS USER_COUNT FROM rfm GROUP BY 1",
    "overview_kpis": f"""SELECT
  (SELECT {AVG_REVENUE.format('LIFETIME_CENTS')} FROM buyers) AS AVG_CLV,
  (SELECT count(*) FROM rfm WHERE RFM_SEGMENT = 'VIP') AS VIP_COUNT,
  (SELECT count(*) FROM churn WHERE CHURN_STATUS = 'AT_RISK') AS AT_RISK_COUNT,
  (SELECT {money('sum(CENTS)')} FROM monthly WHERE PERIOD_START_DATE = (SELECT max(PERIOD_START_DATE) FROM monthly)) AS LATEST_MONTH_REVENUE,
  (SELECT {MEMBER_SHARE} FROM loyalty) AS MEMBER_SHARE_PCT,
  (SELECT RESTAURANT_ID_DISPLAY FROM restaurant_names ORDER BY REVENUE_RANK, RESTAURANT_ID LIMIT 1) AS TOP_RESTAURANT,
  (SELECT {DISCOUNT_SHARE} FROM discount_sums) AS DISCOUNTED_SHARE_PCT""",
    "overview_top5_trend": f"""SELECT PERIOD_START_DATE, RESTAURANT_ID, {SUM_REVENUE}, '...' || right(RESTAURANT_ID, 3) AS RESTAURANT_ID_DISPLAY
  FROM monthly WHERE RESTAURANT_ID IN (SELECT RESTAURANT_ID FROM monthly GROUP BY 1 ORDER BY sum(CENTS) DESC, RESTAURANT_ID LIMIT 5)
  GROUP BY PERIOD_START_DATE, RESTAURANT_ID""",
    "clv_kpis": f"""SELECT count(DISTINCT USER_ID) AS USER_COUNT, {AVG_REVENUE.format('LIFETIME_CENTS')} AS AVG_REVENUE,
  {money('sum(LIFETIME_CENTS)')} AS TOTAL_REVENUE,
  {', '.join(f"(SELECT {scaled('E4', 4, 34)} FROM percentiles WHERE P = {p}) AS {name}" for p, name in
             [(50, 'MEDIAN_REVENUE'), (90, 'P90_REVENUE'), (95, 'P95_REVENUE'), (99, 'P99_REVENUE')])} FROM buyers""",
    "clv_segment_distribution": """SELECT s AS CLV_SEGMENT, count(CLV_SEGMENT) AS USER_COUNT,
  100 * count(CLV_SEGMENT) / sum(count(CLV_SEGMENT)) OVER () AS SHARE_PCT
  FROM (VALUES ('HIGH'), ('MEDIUM'), ('LOW')) v(s) LEFT JOIN clv ON CLV_SEGMENT = s GROUP BY s""",
    "clv_histogram": """SELECT least(40, CAST(floor(40 * (V - LO) / (HI - LO) + 1) AS BIGINT)) AS BIN, count(*) AS USER_COUNT
  FROM histogram_rows, (SELECT min(V) AS LO, max(V) AS HI FROM histogram_rows) GROUP BY 1""",
    "top_customers": f"""SELECT USER_ID, {LIFETIME}, CLV_QUINTILE, CLV_SEGMENT FROM clv
  ORDER BY LIFETIME_CENTS DESC, USER_ID LIMIT 10""",
    "rfm_segment_distribution": """SELECT s AS RFM_SEGMENT, count(RFM_SEGMENT) AS USER_COUNT
  FROM (VALUES ('VIP'), ('NEW_CUSTOMER'), ('CHURN_RISK'), ('OTHER')) v(s) LEFT JOIN rfm ON RFM_SEGMENT = s GROUP BY s""",
    "rfm_table": f"SELECT {RFM_COLUMNS} FROM rfm",
    "churn_kpis": """SELECT count(*) FILTER (CHURN_STATUS = 'AT_RISK') AS AT_RISK_COUNT,
  count(*) FILTER (CHURN_STATUS = 'NOT_AT_RISK') AS NOT_AT_RISK_COUNT,
  100 * count(*) FILTER (CHURN_STATUS = 'AT_RISK') / count(*) AS AT_RISK_RATE_PCT,
  avg(DAYS_SINCE_LAST_ORDER) AS AVG_DAYS_SINCE_LAST_ORDER FROM churn""",
    "churn_status_counts": "SELECT CHURN_STATUS, count(*) AS USER_COUNT FROM churn GROUP BY 1",
    "at_risk_customers": "SELECT * FROM churn WHERE CHURN_STATUS = 'AT_RISK'",
    "trend_filter_values": """SELECT DISTINCT 'RESTAURANT_ID' AS FILTER, RESTAURANT_ID AS VALUE FROM daily
  UNION ALL SELECT DISTINCT 'ITEM_CATEGORY', ITEM_CATEGORY FROM daily_named""",
    "trend_filtered": MART_TREND + f"daily_named WHERE {SEVERAL} AND {CHOSEN_DAYS}",
    "trend_kpis_single_category": f"""SELECT {SUM_REVENUE}, {count_of('sum(ORDER_COUNT)')} AS ORDER_COUNT,
  {count_of('sum(ITEM_QUANTITY)')} AS ITEM_QUANTITY,
  {money(half_up('CAST(sum(CENTS) AS BIGINT)', count_of('sum(ORDER_COUNT)')))} AS AVERAGE_ORDER_VALUE
  FROM daily_named WHERE ITEM_CATEGORY = 'ECONOMY' AND {CHOSEN_DAYS}""",
    "trend_kpis_all_categories": f"""SELECT {SUM_REVENUE}, CAST(NULL AS BIGINT) AS ORDER_COUNT,
  {count_of('sum(ITEM_QUANTITY)')} AS ITEM_QUANTITY, CAST(NULL AS DECIMAL(30,2)) AS AVERAGE_ORDER_VALUE FROM weekly""",
    "revenue_over_time": f"SELECT PERIOD_START_DATE, {SUM_REVENUE} FROM monthly GROUP BY 1",
    "orders_over_time": f"""SELECT PERIOD_START_DATE, {count_of('sum(ORDER_COUNT)')} AS ORDER_COUNT FROM daily_named
  WHERE ITEM_CATEGORY = 'ECONOMY' GROUP BY 1""",
    "category_revenue": f"SELECT ITEM_CATEGORY, {SUM_REVENUE} FROM daily_named GROUP BY 1",
    "trend_top_restaurants": f"""SELECT RESTAURANT_ID, {SUM_REVENUE} FROM daily GROUP BY 1
  ORDER BY sum(CENTS) DESC, RESTAURANT_ID LIMIT 10""",
    "loyalty_member_share": f"SELECT {MEMBER_SHARE} AS MEMBER_SHARE_PCT FROM loyalty",
    "loyalty_spend_unpivot": """SELECT LOYALTY_STATUS, 'Avg lifetime revenue / USER_ID' AS METRIC,
  AVG_LIFETIME_REVENUE_PER_USER AS VALUE FROM loyalty
  UNION ALL SELECT LOYALTY_STATUS, 'Average order value', AVG_ORDER_VALUE FROM loyalty""",
    "restaurant_kpis": f"""SELECT (SELECT RESTAURANT_ID_DISPLAY FROM restaurant_names ORDER BY REVENUE_RANK, RESTAURANT_ID LIMIT 1) AS TOP_RESTAURANT,
  count(DISTINCT RESTAURANT_ID) AS RESTAURANT_COUNT, {AVG_REVENUE.format('CENTS')} AS AVG_REVENUE FROM restaurant_sums""",
    "restaurant_focus": """SELECT RESTAURANT_ID, RESTAURANT_ID_DISPLAY, REVENUE_RANK, TOTAL_REVENUE, AVERAGE_ORDER_VALUE,
  REVENUE_PER_USER, ORDER_COUNT, USER_COUNT, AVG_DAILY_ORDERS, AVG_WEEKLY_ORDERS FROM restaurant_names
  WHERE RESTAURANT_ID = 'R007'""",
    "restaurant_table": """SELECT REVENUE_RANK, RESTAURANT_ID_DISPLAY, RESTAURANT_ID, TOTAL_REVENUE, AVERAGE_ORDER_VALUE,
  ORDER_COUNT, FIRST_ORDER_DATE, LAST_ORDER_DATE, ACTIVE_CALENDAR_DAYS, AVG_DAILY_ORDERS, ACTIVE_CALENDAR_WEEKS,
  AVG_WEEKLY_ORDERS, USER_COUNT, REVENUE_PER_USER FROM restaurant_names""",
    "top_restaurants": """SELECT RESTAURANT_ID, RESTAURANT_ID_DISPLAY, REVENUE_RANK, TOTAL_REVENUE FROM restaurant_names
  ORDER BY REVENUE_RANK, RESTAURANT_ID LIMIT 10""",
    "bottom_restaurants": """SELECT RESTAURANT_ID, RESTAURANT_ID_DISPLAY, REVENUE_RANK, TOTAL_REVENUE FROM restaurant_names
  ORDER BY TOTAL_REVENUE, RESTAURANT_ID LIMIT 10""",
    "discount_kpis": f"""SELECT {count_of("coalesce(sum(ORDER_COUNT) FILTER (DISCOUNT_STATUS = 'DISCOUNTED'), 0)")} AS DISCOUNTED_ORDERS,
  {count_of('coalesce(sum(ORDER_COUNT), 0)')} AS TOTAL_ORDERS, {DISCOUNT_SHARE} AS DISCOUNTED_SHARE_PCT FROM discount_sums""",
    "short_ids": """SELECT DISTINCT USER_ID, CASE WHEN USER_ID IS NULL THEN 'N/A' WHEN length(USER_ID) <= 3 THEN USER_ID
  ELSE '...' || right(USER_ID, 3) END AS USER_ID_DISPLAY FROM order_rows""",
    "conform_order_items": f"""SELECT APP_NAME, RESTAURANT_ID, CREATION_TIME_UTC, ORDER_ID, USER_ID, PRINTED_CARD_NUMBER, IS_LOYALTY,
  CURRENCY, LINEITEM_ID, ITEM_CATEGORY, ITEM_NAME, CAST(CAST(l_extendedprice AS FLOAT) AS DOUBLE) AS ITEM_PRICE, ITEM_QUANTITY,
  {LINEAGE.format('order_items')} FROM items""",
    "conform_options": f"SELECT *, {LINEAGE.format('order_item_options')} FROM options",
    "conform_date_dim": f"""SELECT DATE_KEY, CAST(year(DATE_KEY) AS SMALLINT) AS YEAR, CAST(month(DATE_KEY) AS TINYINT) AS MONTH,
  CAST(week(DATE_KEY) AS TINYINT) AS WEEK, dayname(DATE_KEY) AS DAY_OF_WEEK,
  CASE WHEN isodow(DATE_KEY) >= 6 THEN 'TRUE' ELSE 'FALSE' END AS IS_WEEKEND,
  CASE WHEN strftime(DATE_KEY, '%m-%d') IN ('01-01', '07-04', '12-25') THEN 'TRUE' ELSE 'FALSE' END AS IS_HOLIDAY,
  CASE strftime(DATE_KEY, '%m-%d') WHEN '01-01' THEN 'New Year' WHEN '07-04' THEN 'Independence Day'
    WHEN '12-25' THEN 'Christmas Day' END AS HOLIDAY_NAME,
  {LINEAGE.format('date_dim')} FROM days""",
    "parse_offset_timestamps": """SELECT ORDER_ID, LINEITEM_ID, CASE COARSE_LINE WHEN 'L7' THEN NULL
  WHEN 'L6' THEN date_trunc('day', CREATION_TIME_UTC) ELSE CREATION_TIME_UTC END AS PARSED_AT FROM items""",
    "exact_dedup": "SELECT DISTINCT * FROM options",
    "snapshot_sync_changes": "SELECT * FROM changes",
    "snapshot_sync_summary": f"""SELECT
  {', '.join(f"count(*) FILTER (ACTION = '{a}') AS {a}_ROWS" for a in ('INSERT', 'UPDATE', 'DELETE', 'UNCHANGED'))},
  count(*) FILTER (ACTION <> 'INSERT') AS TARGET_ROWS, count(*) FILTER (ACTION <> 'DELETE') AS FINAL_ROWS FROM changes""",
    "conflicting_records": """SELECT ORDER_ID, LINEITEM_ID, RESTAURANT_ID, CREATION_TIME_UTC, ITEM_NAME, ITEM_QUANTITY
  FROM coarse SEMI JOIN (SELECT * FROM coarse_conflicts ORDER BY ALL LIMIT 20)
  USING (ORDER_ID, LINEITEM_ID, RESTAURANT_ID, CREATION_TIME_UTC)""",
    "conflicting_options": """SELECT DISTINCT f.* FROM flawed_options f JOIN (SELECT * FROM option_conflicts
    ORDER BY ORDER_ID NULLS FIRST, LINEITEM_ID, OPTION_GROUP_NAME, OPTION_NAME LIMIT 20) c
  ON f.ORDER_ID = c.ORDER_ID AND f.LINEITEM_ID = c.LINEITEM_ID AND f.OPTION_GROUP_NAME = c.OPTION_GROUP_NAME
    AND f.OPTION_NAME = c.OPTION_NAME""",
    "schema_check": """SELECT 'order_items' AS "TABLE", 16 AS "COLUMNS", count(*) AS "ROWS" FROM items
  UNION ALL SELECT 'order_item_options', 9, count(*) FROM options UNION ALL SELECT 'date_dim', 11, count(*) FROM days""",
    "lineage_columns": f"""SELECT {LINEAGE.format('order_item_options')}, count(*) AS "ROWS" FROM options""",
    "pipeline_run_summary": """SELECT * FROM (
  SELECT STEP, T AS "TABLE", METRIC, N AS VALUE FROM table_sizes, (VALUES ('ingest', 'ROWS'), ('conform', 'ROWS'),
    ('sync', 'INSERT_ROWS'), ('sync', 'FINAL_ROWS')) m(STEP, METRIC)
  UNION ALL SELECT 'sync', T, 'VERSION', 1 FROM table_sizes
  UNION ALL SELECT 'mart', T, 'ROWS', N FROM mart_sizes
  UNION ALL SELECT 'profile', 'customer_rfm', RFM_SEGMENT, count(*) FROM rfm GROUP BY 3
  UNION ALL SELECT 'profile', 'orders', 'NULL_USER_ORDERS', count(*) FILTER (USER_ID IS NULL) FROM order_rows
  UNION ALL SELECT 'profile', 'orders', 'BLANK_USER_ORDERS', count(*) FILTER (trim(USER_ID) = '') FROM order_rows
  UNION ALL SELECT 'profile', 'orders', 'CUSTOMER_ORDERS', count(*) FROM buyer_orders
  UNION ALL SELECT 'profile', 'orders', 'CUSTOMERS', count(*) FROM buyers)
WHERE VALUE <> 0""",
    "mart_round_trip": f"""SELECT {RFM_COLUMNS}, TIMESTAMP '2026-01-01 00:00:00' AS _GENERATED_AT, AD AS _ANALYSIS_DATE
  FROM rfm CROSS JOIN last_day""",
    "snapshot_initial_sync": """SELECT CAST(RUN AS INT) AS RUN, METRIC, CASE WHEN METRIC IN (
      CASE WHEN RUN = 1 THEN 'INSERT_ROWS' ELSE 'UNCHANGED_ROWS' END, 'FINAL_ROWS',
      CASE WHEN RUN = 2 THEN 'TARGET_ROWS' END) THEN N WHEN METRIC = 'VERSION' THEN 1 ELSE 0 END AS VALUE
  FROM (VALUES (1), (2)) r(RUN), (VALUES ('INSERT_ROWS'), ('UPDATE_ROWS'), ('DELETE_ROWS'), ('UNCHANGED_ROWS'),
    ('TARGET_ROWS'), ('FINAL_ROWS'), ('VERSION')) m(METRIC), (SELECT count(*) AS N FROM options)""",
    "post_merge_checks": """SELECT count(*) AS "ROWS", CAST(0 AS BIGINT) AS DUPLICATE_KEYS FROM newer""",
    "sync_changed_buckets": """SELECT ACTION, ORDER_ID, LINEITEM_ID, RESTAURANT_ID, CREATION_TIME_UTC, CAST(BUCKET AS INT) AS BUCKET,
  (SELECT count(*) FROM week_changes WHERE ACTION = 'UNCHANGED') AS UNCHANGED_ROWS, (SELECT count(*) FROM week_after) AS FINAL_ROWS,
  (SELECT count(DISTINCT BUCKET) FROM week_changes w WHERE ACTION <> 'INSERT' AND BUCKET IN (
    SELECT BUCKET FROM week_changes WHERE ACTION <> 'UNCHANGED')) AS BUCKETS_READ,
  (SELECT count(DISTINCT BUCKET) FROM week_changes w WHERE ACTION <> 'DELETE' AND BUCKET IN (
    SELECT BUCKET FROM week_changes WHERE ACTION <> 'UNCHANGED')) AS BUCKETS_WRITTEN
  FROM week_changes WHERE ACTION <> 'UNCHANGED'""",
    "mart_refresh": f"""SELECT 'sales_trends_daily' AS MART, {TREND_KEY} AS "KEY", {money('CENTS')} AS TOTAL_REVENUE, ORDER_COUNT, ITEM_QUANTITY AS OTHER,
    '' AS LABEL FROM daily
  UNION ALL SELECT 'sales_trends_weekly', {TREND_KEY}, {money('CENTS')}, ORDER_COUNT, ITEM_QUANTITY, '' FROM weekly
  UNION ALL SELECT 'sales_trends_monthly', {TREND_KEY}, {money('CENTS')}, ORDER_COUNT, ITEM_QUANTITY, '' FROM monthly
  UNION ALL SELECT 'churn_indicators', USER_ID, CURRENT_30_DAY_SPEND, LIFETIME_ORDER_COUNT, DAYS_SINCE_LAST_ORDER, CHURN_STATUS FROM churn
  UNION ALL SELECT 'loyalty_program_impact', LOYALTY_STATUS, TOTAL_REVENUE, ORDER_COUNT, USER_COUNT, CAST(AVG_LIFETIME_REVENUE_PER_USER AS VARCHAR) FROM loyalty
  UNION ALL SELECT 'restaurant_performance', RESTAURANT_ID, TOTAL_REVENUE, ORDER_COUNT, USER_COUNT,
    concat_ws('|', CAST(FIRST_ORDER_DATE AS VARCHAR), CAST(LAST_ORDER_DATE AS VARCHAR), CAST(REVENUE_RANK AS VARCHAR), CAST(REVENUE_PER_USER AS VARCHAR)) FROM restaurants
  UNION ALL SELECT 'discount_effectiveness', DISCOUNT_STATUS, {money('CENTS')}, ORDER_COUNT, USER_COUNT, '' FROM discount_sums""",
    "keyed_key_work": """SELECT * FROM (
    SELECT 'ITEM_KEYS' AS STEP, 'ROWS' AS METRIC, count(*) AS VALUE FROM newer
    UNION ALL SELECT 'ITEM_KEYS', 'DUPLICATE_KEYS', 0 UNION ALL SELECT 'OPTION_KEYS', 'DUPLICATE_KEYS', 0
    UNION ALL SELECT 'JOIN_KEYS', 'DUPLICATE_KEYS', 0 UNION ALL SELECT 'OPTION_KEYS', 'ROWS', count(*) FROM (SELECT DISTINCT * FROM options)
    UNION ALL SELECT 'JOIN_KEYS', 'ROWS', count(*) FROM newer UNION ALL SELECT 'LINES', 'ROWS', count(*) FROM newer
    UNION ALL SELECT 'MERGE', a || '_ROWS', count(ACTION) FROM (VALUES ('INSERT'), ('UPDATE'), ('DELETE'), ('UNCHANGED')) v(a)
      LEFT JOIN changes ON ACTION = a GROUP BY a
    UNION ALL SELECT 'MERGE', 'TARGET_ROWS', count(*) FROM older UNION ALL SELECT 'MERGE', 'FINAL_ROWS', count(*) FROM newer
    UNION ALL SELECT 'LINES', 'OPTIONS', CAST(sum(OPTION_COUNT) AS BIGINT) FROM newer n JOIN option_sums s
      ON n.ORDER_ID = s.ORDER_ID AND n.LINEITEM_ID = s.LINEITEM_ID
    UNION ALL SELECT 'LINES', 'REVENUE_CENTS', CAST(sum(PRICE_CENTS + coalesce(OPTION_CENTS, 0)) AS BIGINT) FROM newer n LEFT JOIN option_sums s
      ON n.ORDER_ID = s.ORDER_ID AND n.LINEITEM_ID = s.LINEITEM_ID
    UNION ALL SELECT 'ORPHANS', 'ROWS', count(*) FROM options o WHERE NOT EXISTS (
      SELECT 1 FROM newer n WHERE n.ORDER_ID = o.ORDER_ID AND n.LINEITEM_ID = o.LINEITEM_ID))""",
    "customer_page": "SELECT USER_ID, RECENCY_DAYS, RFM_SEGMENT FROM rfm ORDER BY RECENCY_DAYS DESC, USER_ID LIMIT 25 OFFSET 50",
    "customers_after": """SELECT USER_ID, RECENCY_DAYS, RFM_SEGMENT FROM rfm WHERE RECENCY_DAYS < 200 OR (RECENCY_DAYS = 200 AND USER_ID > 'C5')
  ORDER BY RECENCY_DAYS DESC, USER_ID LIMIT 25""",
    "orders_of_categories": """SELECT CAST(date_trunc('month', ORDER_DATE) AS DATE) AS PERIOD_START_DATE, RESTAURANT_ID,
  count(DISTINCT (ORDER_ID, RESTAURANT_ID)) AS ORDER_COUNT FROM sales WHERE ITEM_CATEGORY IN ('ECONOMY', 'SMALL', 'UNKNOWN') GROUP BY ALL""",
    "trend_clustered": MART_TREND + f"daily_named WHERE {SEVERAL} AND {CHOSEN_DAYS}",
    "footer_summary": """SELECT count(*) AS "ROWS", min(PERIOD_START_DATE) AS MIN_PERIOD_START_DATE, max(PERIOD_START_DATE) AS MAX_PERIOD_START_DATE,
  min(ORDER_COUNT) AS MIN_ORDER_COUNT, max(ORDER_COUNT) AS MAX_ORDER_COUNT FROM daily""",
    "trend_of_restaurants": MART_TREND + "(SELECT * REPLACE (coalesce(ITEM_CATEGORY, 'UNKNOWN') AS ITEM_CATEGORY) FROM monthly) WHERE RESTAURANT_ID IN ('R001', 'R007', 'R013')",
    "rfm_table_of_segments": f"SELECT {RFM_COLUMNS} FROM rfm WHERE RFM_SEGMENT IN ('VIP', 'CHURN_RISK')",
    "gate_cast_failures": """SELECT 'order_items' AS "TABLE", 'CAST_CREATION_TIME_UTC' AS RULE,
    count(*) FILTER (CREATION_TIME_UTC IS NULL) AS VIOLATIONS FROM flawed
  UNION ALL SELECT 'order_items', 'CAST_ITEM_PRICE', 0 UNION ALL SELECT 'order_items', 'CAST__INGESTED_AT', 0
  UNION ALL SELECT 'order_items', 'CAST_ITEM_QUANTITY', count(*) FILTER (ITEM_QUANTITY IS NULL) FROM flawed
  UNION ALL SELECT 'order_item_options', 'CAST_OPTION_PRICE', count(*) FILTER (OPTION_PRICE IS NULL) FROM flawed_options
  UNION ALL SELECT 'order_item_options', RULE, 0 FROM (VALUES ('CAST_OPTION_QUANTITY'), ('CAST__INGESTED_AT')) v(RULE)
  UNION ALL SELECT 'date_dim', 'CAST_YEAR', count(*) FILTER (M = 2) FROM flawed_days
  UNION ALL SELECT 'date_dim', RULE, 0
    FROM (VALUES ('CAST_DATE_KEY'), ('CAST_MONTH'), ('CAST_WEEK'), ('CAST__INGESTED_AT')) v(RULE)""",
    "gate_null_keys": """SELECT 'order_items' AS "TABLE", 'NULL_KEY_ORDER_ITEMS' AS RULE,
    count(*) FILTER (ORDER_ID IS NULL OR CREATION_TIME_UTC IS NULL) AS VIOLATIONS FROM flawed
  UNION ALL SELECT 'order_item_options', 'NULL_KEY_ORDER_ITEM_OPTIONS', count(*) FILTER (ORDER_ID IS NULL) FROM flawed_options
  UNION ALL SELECT 'date_dim', 'NULL_KEY_DATE_DIM', count(*) FILTER (DATE_KEY IS NULL) FROM flawed_days""",
    "gate_conflicting_keys": """SELECT 'order_items' AS "TABLE", 'DUPLICATE_KEY_ORDER_ITEMS' AS RULE, count(*) AS VIOLATIONS
    FROM coarse_conflicts
  UNION ALL SELECT 'order_item_options', 'DUPLICATE_KEY_ORDER_ITEM_OPTIONS', count(*) FROM option_conflicts
  UNION ALL SELECT 'date_dim', 'DUPLICATE_KEY_DATE_DIM', count(*) FILTER (M = 1)
    + CASE WHEN count(DISTINCT (Y, W)) FILTER (DATE_KEY IS NULL) > 1 THEN 1 ELSE 0 END FROM flawed_days""",
    "gate_unsafe_join_keys": """SELECT 'UNSAFE_OPTION_JOIN_KEY' AS RULE, count(*) AS VIOLATIONS
  FROM (SELECT ORDER_ID, COARSE_LINE FROM items GROUP BY ALL HAVING count(*) > 1)""",
    "gate_revenue_nulls": """SELECT 'NULL_ITEM_PRICE' AS RULE, count(*) FILTER (ITEM_PRICE IS NULL) AS VIOLATIONS FROM flawed
  UNION ALL SELECT 'NULL_OPTION_PRICE_OR_QUANTITY', count(*) FILTER (OPTION_PRICE IS NULL OR OPTION_QUANTITY IS NULL)
  FROM flawed_options""",
    "gate_invalid_loyalty": """SELECT IS_LOYALTY, count(*) AS VIOLATIONS FROM flawed
  WHERE upper(trim(IS_LOYALTY)) NOT IN ('TRUE', 'FALSE') GROUP BY 1""",
    "gate_order_consistency": """SELECT 'ORDER_WITH_SEVERAL_USERS' AS RULE, count(*) FILTER (U > 1) AS VIOLATIONS FROM (
    SELECT count(DISTINCT USER_ID) AS U FROM flawed GROUP BY ORDER_ID, RESTAURANT_ID)
  UNION ALL SELECT 'ORDER_WITH_SEVERAL_LOYALTY', count(*) FILTER (F > 1) FROM (
    SELECT count(DISTINCT LOYALTY_FLAG) AS F FROM flawed GROUP BY ORDER_ID, RESTAURANT_ID)""",
    "coerced_types": """SELECT ORDER_ID, LINEITEM_ID, ITEM_NAME, CAST(ITEM_QUANTITY AS DOUBLE) AS ITEM_QUANTITY,
  CREATION_TIME_UTC FROM flawed""",
}


#: Statements over the lines of the later snapshot.
AFTER_THE_LAST_WEEK = {"mart_refresh"}
LATER_ITEMS = (
    PARTS["items"].replace(FLOAT_CENTS, f"CASE WHEN o_orderdate >= DATE '2001-07-01' AND l_linestatus = 'O' THEN {FLOAT_CENTS.replace('l_extendedprice', 'l_extendedprice + 1')} ELSE {FLOAT_CENTS} END")
    + " WHERE NOT (o_orderdate >= DATE '2001-07-01' AND l_returnflag = 'R')"
)


def _needed(sql: str, found: dict[str, None]) -> dict[str, None]:
    """The named parts a statement uses, each after the ones it uses itself."""
    words = set(re.findall(r"[a-z_]+", sql))
    for name, text in PARTS.items():
        if name in words and name not in found:
            _needed(text, found)
            found[name] = None
    return found


def oracle_sql() -> dict[str, str]:
    statements = {}
    for name, sql in QUERIES.items():
        texts = PARTS | {"items": LATER_ITEMS} if name in AFTER_THE_LAST_WEEK else PARTS
        parts = ",\n".join(f"{part} AS ({texts[part]}\n)" for part in _needed(sql, {}))
        statements[name] = f"WITH {parts}\n{sql}"
    return statements
