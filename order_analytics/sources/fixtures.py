"""Order data derived from the test tables (see FIXTURES.md). Map-like: only the two key joins shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CREATED = (
    "CAST(o_orderdate AS timestamp)"
    " + make_interval(0, 0, 0, 0, 0, CAST(l_orderkey % 1440 AS int), l_linenumber)"
)
LINE_ID = (
    "concat('L', l_linenumber, '-', l_partkey, '-', l_suppkey, '-', unix_date(CAST(l_shipdate AS date)))"
)
COARSE_LINE_ID = "concat('L', l_linenumber)"

ITEM_COLUMNS = {
    "APP_NAME": "'APP'",
    "RESTAURANT_ID": "concat('R', lpad(CAST(l_suppkey % 5 + 5 * (l_orderkey % 8) AS string), 3, '0'))",
    "CREATION_TIME_UTC": CREATED,
    "ORDER_ID": "concat('O', l_orderkey)",
    "USER_ID": (
        "CASE WHEN o_custkey % 50 = 0 THEN NULL WHEN o_custkey % 50 = 1 THEN '   '"
        " WHEN o_custkey % 50 = 2 THEN concat(' C', o_custkey, ' ') ELSE concat('C', o_custkey) END"
    ),
    "PRINTED_CARD_NUMBER": "CAST(NULL AS string)",
    "IS_LOYALTY": "CASE o_orderstatus WHEN 'F' THEN 'TRUE' WHEN 'O' THEN ' false ' END",
    "CURRENCY": "'USD'",
    "LINEITEM_ID": LINE_ID,
    "ITEM_CATEGORY": "CASE WHEN p_size = 50 THEN NULL ELSE p_type END",
    "ITEM_NAME": "p_name",
    "ITEM_PRICE": "CAST(l_extendedprice AS float)",
    "ITEM_QUANTITY": "CASE WHEN l_linenumber = 7 THEN NULL ELSE CAST(l_quantity AS int) END",
}

#: The price at its final width before the lines travel to their order and part.
AS_PRICED = {"l_extendedprice": ITEM_COLUMNS["ITEM_PRICE"]}

# Rows that break the gates, each by its own rule.
FLAWED_COLUMNS = {
    "ORDER_ID": "CASE WHEN l_quantity = 49 THEN NULL ELSE concat('O', l_orderkey) END",
    "CREATION_TIME_UTC": (
        f"CASE WHEN l_tax = 0 AND l_linestatus = 'O' THEN 'unknown' ELSE concat(CAST({CREATED} AS string), ' +00:00') END"
    ),
    "USER_ID": "CASE WHEN l_returnflag = 'R' THEN 'GUEST' ELSE concat('C', o_custkey) END",
    "IS_LOYALTY": (
        "CASE WHEN o_orderstatus = 'P' THEN 'PENDING' WHEN o_orderstatus = 'F' THEN 'TRUE'"
        " WHEN l_linestatus = 'O' THEN 'False' END"
    ),
    "LINEITEM_ID": COARSE_LINE_ID,
    "ITEM_PRICE": "CASE WHEN l_discount = 0.1 THEN NULL ELSE CAST(l_extendedprice AS string) END",
    "ITEM_QUANTITY": "CASE WHEN l_quantity = 50 THEN 'many' ELSE CAST(CAST(l_quantity AS int) AS string) END",
}

# The same instant in the layouts a source may send, one per line number; the last is no timestamp.
OFFSET_TEXT = f"""
CASE l_linenumber
  WHEN 1 THEN date_format({CREATED}, "yyyy-MM-dd HH:mm:ss'.0000000 +00:00'")
  WHEN 2 THEN date_format({CREATED}, "yyyy-MM-dd HH:mm:ss'.000000+00:00'")
  WHEN 3 THEN date_format({CREATED}, "yyyy-MM-dd'T'HH:mm:ss'Z'")
  WHEN 4 THEN date_format({CREATED} + INTERVAL '5:30' HOUR TO MINUTE, "yyyy-MM-dd HH:mm:ss' +05:30'")
  WHEN 5 THEN date_format({CREATED} - INTERVAL '8' HOUR, "'  'yyyy-MM-dd HH:mm:ss.SSS'-08:00 '")
  WHEN 6 THEN date_format({CREATED}, "yyyy-MM-dd")
  ELSE concat('line ', l_linenumber)
END
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _lines(spark: SparkSession, sf_dir: str, **narrowed: str) -> DataFrame:
    """Lines with their order and part. ``narrowed`` has what to keep of columns of the lines, so that no more of them travels."""
    lines = table(spark, sf_dir, "lineitem")
    kept = {"l_shipdate": "CAST(l_shipdate AS date)", **narrowed}
    lines = lines.withColumns({name: F.expr(text) for name, text in kept.items()})
    orders = table(spark, sf_dir, "orders")
    parts = table(spark, sf_dir, "part")
    return lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).join(
        orders, F.col("l_orderkey") == F.col("o_orderkey")
    )


def _select(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.select(*[F.expr(text).alias(name) for name, text in columns.items()])


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _select(_lines(spark, sf_dir, **AS_PRICED), ITEM_COLUMNS)


def coarse_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines known by their line number alone, which is not unique within an order."""
    return _select(_lines(spark, sf_dir, **AS_PRICED), ITEM_COLUMNS | {"LINEITEM_ID": COARSE_LINE_ID})


def order_item_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A size option on taxed lines and a promotion on small lines, from one scan."""
    both = F.expr(
        "stack(2,"
        " 'SIZE', l_returnflag, CAST(round(l_tax * 100) AS decimal(18,0)), CAST(l_linenumber AS decimal(18,0)),"
        " 'PROMO', l_linestatus, CAST(round(l_discount * 100) AS decimal(18,0)), CAST(1 AS decimal(18,0)))"
        " AS (OPTION_GROUP_NAME, OPTION_NAME, OPTION_PRICE, OPTION_QUANTITY)"
    )
    options = table(spark, sf_dir, "lineitem").select(
        F.expr("concat('O', l_orderkey)").alias("ORDER_ID"), F.expr(LINE_ID).alias("LINEITEM_ID"), "l_tax", "l_quantity", both
    )
    return options.filter("CASE OPTION_GROUP_NAME WHEN 'SIZE' THEN l_tax > 0 ELSE l_quantity <= 10 END").drop(
        "l_tax", "l_quantity"
    )


def date_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per day from the first to the last order date; ISO weeks, English day names."""
    span = table(spark, sf_dir, "orders").select(
        F.min("o_orderdate").cast("date").alias("FIRST"), F.max("o_orderdate").cast("date").alias("LAST")
    )
    days = span.select(F.explode(F.sequence("FIRST", "LAST")).alias("DATE_KEY"))
    holiday = (
        F.when(F.date_format("DATE_KEY", "MM-dd") == "01-01", "New Year")
        .when(F.date_format("DATE_KEY", "MM-dd") == "07-04", "Independence Day")
        .when(F.date_format("DATE_KEY", "MM-dd") == "12-25", "Christmas Day")
    )
    return days.select(
        "DATE_KEY",
        F.year("DATE_KEY").cast("smallint").alias("YEAR"),
        F.month("DATE_KEY").cast("tinyint").alias("MONTH"),
        F.weekofyear("DATE_KEY").cast("tinyint").alias("WEEK"),
        F.date_format("DATE_KEY", "EEEE").alias("DAY_OF_WEEK"),
        F.when(F.weekday("DATE_KEY") >= 5, "TRUE").otherwise("FALSE").alias("IS_WEEKEND"),
        F.when(holiday.isNotNull(), "TRUE").otherwise("FALSE").alias("IS_HOLIDAY"),
        holiday.alias("HOLIDAY_NAME"),
    )


def _as_raw(df: DataFrame, source: str) -> DataFrame:
    """All text, names as a source would spell them, with lineage."""
    texts = df.select(
        *[F.col(name).cast("string").alias(name.replace("_", " ").title()) for name in df.columns]
    )
    return texts.withColumns(
        {
            "_ingested_at": F.lit("2026-01-01 00:00:00"),
            "_source table": F.lit(source),
            "_Load-Type": F.lit("FULL_DAILY"),
        }
    )


def raw_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    offset = {"CREATION_TIME_UTC": f"concat(CAST({CREATED} AS string), '.000000 +00:00')"}
    return _as_raw(_select(_lines(spark, sf_dir, **AS_PRICED), ITEM_COLUMNS | offset), "order_items")


def flawed_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_raw(_select(_lines(spark, sf_dir), ITEM_COLUMNS | FLAWED_COLUMNS), "order_items")


def raw_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_raw(order_item_options(spark, sf_dir), "order_item_options")


def raw_date_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_raw(date_dim(spark, sf_dir), "date_dim")


def flawed_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Options with prices that are no numbers, missing quantities and orders, and lines known by number alone."""
    price, quantity = F.col("OPTION_PRICE"), F.col("OPTION_QUANTITY")
    flawed = order_item_options(spark, sf_dir).select(
        F.when(price != 7, F.col("ORDER_ID")).alias("ORDER_ID"),
        F.split_part("LINEITEM_ID", F.lit("-"), F.lit(1)).alias("LINEITEM_ID"),
        "OPTION_GROUP_NAME",
        "OPTION_NAME",
        F.when(price == 5, "free").otherwise(price.cast("string")).alias("OPTION_PRICE"),
        F.when(quantity != 3, quantity).alias("OPTION_QUANTITY"),
    )
    return _as_raw(flawed, "order_item_options")


def flawed_date_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A calendar with days missing in March, years that are no numbers in February, and January twice."""
    days = date_dim(spark, sf_dir)
    march_sunday = (F.col("MONTH") == 3) & (F.col("DAY_OF_WEEK") == "Sunday")
    flawed = days.withColumns(
        {
            "DATE_KEY": F.when(~march_sunday, F.col("DATE_KEY")),
            "YEAR": F.when(F.col("MONTH") == 2, "n/a").otherwise(F.col("YEAR").cast("string")),
        }
    )
    return _as_raw(flawed.unionByName(flawed.filter("MONTH = 1").withColumn("HOLIDAY_NAME", F.lit("Other"))), "date_dim")


def order_items_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines among which those without a category are missing, so that some options have no line."""
    return order_items(spark, sf_dir).filter(F.col("ITEM_CATEGORY").isNotNull())


def offset_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").join(
        table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey")
    )
    return _select(lines, {"ORDER_ID": "concat('O', l_orderkey)", "LINEITEM_ID": LINE_ID, "RAW_TEXT": OFFSET_TEXT})


def repeated_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All options, and the promotions once more as exact copies."""
    options = order_item_options(spark, sf_dir)
    return options.unionAll(options.filter(F.col("OPTION_GROUP_NAME") == "PROMO"))


def earlier_order_items(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> DataFrame:
    """An older snapshot: without the orders of 2001, and with open lines at another price. ``lines`` are the ``joined_lines``, where they are there already."""
    price = "CAST(CASE WHEN l_linestatus = 'O' THEN l_extendedprice + 1 ELSE l_extendedprice END AS float)"
    older = _lines(spark, sf_dir, l_extendedprice=price) if lines is None else lines.withColumn("l_extendedprice", F.expr(price))
    return _select(older.filter("o_orderdate < DATE'2001-01-01'"), ITEM_COLUMNS)


def later_order_items(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> DataFrame:
    """A newer snapshot: returned lines are gone. ``lines`` as above."""
    newer = _lines(spark, sf_dir, **AS_PRICED) if lines is None else lines
    return _select(newer.filter("l_returnflag <> 'R'"), ITEM_COLUMNS)


LAST_MONTH, LAST_WEEK = "o_orderdate >= DATE'2001-07-01'", "o_orderdate >= DATE'2001-07-25'"


def joined_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with their order and part, by the columns that pairs of snapshots are made of."""
    columns = [
        *("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag", "l_linestatus", "l_shipdate"),
        *("o_custkey", "o_orderstatus", "o_orderdate", "p_name", "p_type", "p_size"),
    ]
    return _lines(spark, sf_dir).select(columns)


def order_items_before_the_last_week(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> DataFrame:
    """All lines but those of the newest orders. ``lines`` are the ``joined_lines``, where they are there already."""
    older = _lines(spark, sf_dir, **AS_PRICED) if lines is None else lines
    return _select(older.filter(f"NOT ({LAST_WEEK})"), ITEM_COLUMNS)


def order_items_after_the_last_week(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> DataFrame:
    """The newest orders are there; of the last month, returned lines are gone and open ones have another price."""
    newer = (_lines(spark, sf_dir) if lines is None else lines).filter(f"NOT ({LAST_MONTH} AND l_returnflag = 'R')")
    price = f"CAST(CASE WHEN {LAST_MONTH} AND l_linestatus = 'O' THEN l_extendedprice + 1 ELSE l_extendedprice END AS float)"
    return _select(newer, ITEM_COLUMNS | {"ITEM_PRICE": price})
