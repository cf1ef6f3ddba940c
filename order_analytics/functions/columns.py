"""Column expressions: loyalty flag, offset timestamps, ratios, display ids, lenient casts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(30,2)"
RATE = "decimal(18,4)"
PERCENT = "decimal(10,2)"
WHOLE = "decimal(20,0)"

# Timestamp layouts accepted after Spark's own parser, in order.
OFFSET_TIMESTAMP_LAYOUTS = (
    "yyyy-MM-dd HH:mm:ss.SSSSSSS XXX",
    "yyyy-MM-dd HH:mm:ss.SSSSSSSXXX",
    "yyyy-MM-dd HH:mm:ss.SSSSSS XXX",
    "yyyy-MM-dd HH:mm:ss.SSSSSSXXX",
    "yyyy-MM-dd HH:mm:ss.SSS XXX",
    "yyyy-MM-dd HH:mm:ss.SSSXXX",
    "yyyy-MM-dd HH:mm:ss XXX",
    "yyyy-MM-dd HH:mm:ssXXX",
    "yyyy-MM-dd'T'HH:mm:ss.SSSSSSSXXX",
    "yyyy-MM-dd'T'HH:mm:ssXXX",
)


def as_column(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def loyalty_flag(col: str | Column) -> Column:
    """TRUE -> 1, FALSE -> 0 in any case and padding; anything else -> NULL."""
    word = F.upper(F.trim(as_column(col)))
    return F.when(word == "TRUE", 1).when(word == "FALSE", 0)


def offset_timestamp(col: str | Column) -> Column:
    """Timestamp text with a zone offset -> instant; NULL when no layout fits."""
    text = F.trim(as_column(col).cast("string"))
    layouts = [F.try_to_timestamp(text, F.lit(layout)) for layout in OFFSET_TIMESTAMP_LAYOUTS]
    return F.coalesce(F.try_to_timestamp(text), *layouts)


def money_ratio(amount: str | Column, count: str | Column) -> Column:
    """Decimal amount per counted thing, rounded half up to cents."""
    return (as_column(amount) / as_column(count)).cast(MONEY)


def count_ratio(part: str | Column, whole: str | Column, cast: str, factor: int = 1) -> Column:
    """Ratio of two counts on decimals, so that it rounds exactly; NULL when the whole is not positive."""
    divided = as_column(part).cast(WHOLE) * F.lit(factor).cast("decimal(3,0)") / as_column(whole).cast(WHOLE)
    return F.when(as_column(whole) > 0, divided.cast(cast))


def share_percent(part: Column, whole: Column) -> Column:
    """100 * part / whole as a double; NULL when the whole is zero."""
    return F.try_divide((F.lit(100) * part).cast("double"), whole.cast("double"))


def week_start(day: str | Column) -> Column:
    """The Monday on or before a date."""
    return F.to_date(F.date_trunc("week", as_column(day)))


def month_start(day: str | Column) -> Column:
    return F.trunc(as_column(day), "month")


def is_identified(user: str | Column) -> Column:
    """Neither NULL nor blank (blank means spaces only, as ``trim`` sees it)."""
    return F.coalesce(F.length(F.trim(as_column(user))) > 0, F.lit(False))


def short_id(col: str | Column) -> Column:
    """Last three characters behind an ellipsis; short ids unchanged; NULL -> N/A."""
    text = as_column(col).cast("string")
    shortened = F.when(F.length(text) <= 3, text).otherwise(F.concat(F.lit("..."), F.right(text, F.lit(3))))
    return F.coalesce(shortened, F.lit("N/A"))


def number_or_null(col: str | Column) -> Column:
    return as_column(col).try_cast("double")


def timestamp_or_null(col: str | Column) -> Column:
    return F.try_to_timestamp(as_column(col).cast("string"))
