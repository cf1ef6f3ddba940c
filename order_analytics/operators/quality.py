"""Data-quality gates.

Row rules of one table fold into a single aggregate. Key rules need one shuffle each; partial counts are
taken before it, so a key that many rows share stays cheap.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from order_analytics.functions.columns import is_identified, loyalty_flag
from order_analytics.operators.conform import ORIGINAL
from order_analytics.schemas import TableSpec


class QualityError(RuntimeError):
    """A gate found violations."""


def check_columns(df: DataFrame, spec: TableSpec) -> None:
    """The typed schema is closed: nothing missing, nothing extra."""
    expected, actual = set(spec.schema.names), set(df.columns)
    if expected != actual:
        raise QualityError(
            f"{spec.name}: missing columns {sorted(expected - actual)}, "
            f"unexpected columns {sorted(actual - expected)}"
        )


def any_null(columns) -> Column:
    return reduce(or_, [F.col(name).isNull() for name in columns])


def cast_failure(name: str) -> Column:
    return F.col(ORIGINAL + name).isNotNull() & F.col(name).isNull()


def cast_rules(spec: TableSpec) -> dict[str, Column]:
    """Needs the originals that ``cast_to_schema`` keeps on request."""
    return {f"CAST_{name}": cast_failure(name) for name in spec.watched_casts}


def rounding_rules(spec: TableSpec) -> dict[str, Column]:
    """Decimals that the cast rounded, such as a price below one unit. Reported, not fatal."""
    return {
        f"ROUNDED_{name}": F.col(ORIGINAL + name).try_cast("decimal(38,10)") != F.col(name) for name in spec.decimals
    }


def key_rules(spec: TableSpec) -> dict[str, Column]:
    return {f"NULL_KEY_{spec.name.upper()}": any_null(spec.key)}


def item_revenue_rules() -> dict[str, Column]:
    return {"NULL_ITEM_PRICE": F.col("ITEM_PRICE").isNull()}


def option_revenue_rules() -> dict[str, Column]:
    return {"NULL_OPTION_PRICE_OR_QUANTITY": any_null(["OPTION_PRICE", "OPTION_QUANTITY"])}


def invalid_loyalty() -> Column:
    return F.col("IS_LOYALTY").isNotNull() & loyalty_flag("IS_LOYALTY").isNull()


def loyalty_rules() -> dict[str, Column]:
    return {"UNEXPECTED_IS_LOYALTY": invalid_loyalty()}


def rfm_rules() -> dict[str, Column]:
    return {
        "ZERO_FREQUENCY_SCORE": (F.col("FREQUENCY_6M") == 0) & (F.col("F_SCORE") != 1),
        "ZERO_MONETARY_SCORE": (F.col("MONETARY_6M") == 0) & (F.col("M_SCORE") != 1),
    }


def span_rules() -> dict[str, Column]:
    return {
        "DAY_SPAN_NOT_POSITIVE": F.col("ACTIVE_CALENDAR_DAYS") <= 0,
        "WEEK_SPAN_NOT_POSITIVE": F.col("ACTIVE_CALENDAR_WEEKS") <= 0,
    }


def run_checks(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """``(RULE, VIOLATIONS)``, one row per rule, from one pass over ``df``."""
    counts = df.agg(*[F.count_if(condition).alias(rule) for rule, condition in rules.items()])
    return counts.unpivot([], list(rules), "RULE", "VIOLATIONS")


def duplicate_keys(df: DataFrame, key) -> DataFrame:
    """Keys that more than one row carries, with the row count in ``ROWS``."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("ROWS")).filter("ROWS > 1")


def key_summary(df: DataFrame, key) -> DataFrame:
    """One row: all rows, and the number of keys that more than one row carries."""
    sizes = df.groupBy(*key).agg(F.count(F.lit(1)).alias("SIZE"))
    return sizes.agg(
        F.coalesce(F.sum("SIZE"), F.lit(0)).alias("ROWS"), F.count_if(F.col("SIZE") > 1).alias("DUPLICATE_KEYS")
    )


def key_counts(df: DataFrame, key) -> dict[str, int]:
    """``key_summary`` as figures. Digests of the keys travel; equal keys have equal digests, so only where some repeat do the keys."""
    found = key_summary(df.select(F.xxhash64(*key).alias("DIGEST")), ["DIGEST"]).first().asDict()
    return key_summary(df, key).first().asDict() if found["DUPLICATE_KEYS"] else found


def count_duplicate_keys(df: DataFrame, key, rule: str) -> DataFrame:
    return key_summary(df, key).select(F.lit(rule).alias("RULE"), F.col("DUPLICATE_KEYS").alias("VIOLATIONS"))


def conflicting_records(df: DataFrame, key, keys_shown: int = 20) -> DataFrame:
    """All records of the first conflicting keys, sorted. The sample is bounded, hence the broadcast."""
    shown = duplicate_keys(df, key).select(*key).orderBy(*key).limit(keys_shown)
    rest = [name for name in df.columns if name not in key]
    return df.join(F.broadcast(shown), on=list(key), how="inner").orderBy(*key, *rest)


def invalid_loyalty_values(items: DataFrame) -> DataFrame:
    """The distinct unexpected values and how often each occurs."""
    return items.filter(invalid_loyalty()).groupBy("IS_LOYALTY").agg(F.count(F.lit(1)).alias("VIOLATIONS"))


def order_consistency_checks(items: DataFrame, key=("ORDER_ID", "RESTAURANT_ID")) -> DataFrame:
    """Orders whose lines disagree on user or loyalty; NULLs are no value.

    Plain minima and maxima per order, summed ahead of the shuffle, so an order id that millions of users share is one row for
    each task. Users go by two hashes (96 bits), because aggregates of text would sort the lines.
    """
    user = F.col("USER_ID")
    codes = {"USER_A": F.when(user.isNotNull(), F.xxhash64(user)), "USER_B": F.when(user.isNotNull(), F.hash(user)), "FLAG": loyalty_flag("IS_LOYALTY")}
    ends = [end(code).alias(f"{name}_{number}") for name, code in codes.items() for number, end in enumerate((F.min, F.max))]
    orders = items.groupBy(*key).agg(*ends)
    differs = {name: F.col(f"{name}_0") != F.col(f"{name}_1") for name in codes}
    rules = {"ORDER_WITH_SEVERAL_USERS": differs["USER_A"] | differs["USER_B"], "ORDER_WITH_SEVERAL_LOYALTY": differs["FLAG"]}
    return run_checks(orders, rules)


def enforce_order_consistency(items: DataFrame, table: str) -> dict[str, int]:
    """Enforces ``order_consistency_checks``. Orders go by digest first, which can find too much but miss nothing; only then by their key."""
    digests = items.select(F.xxhash64("ORDER_ID", "RESTAURANT_ID").alias("DIGEST"), "USER_ID", "IS_LOYALTY")
    found = {row["RULE"]: row["VIOLATIONS"] for row in order_consistency_checks(digests, ["DIGEST"]).collect()}
    return enforce(order_consistency_checks(items), table) if any(found.values()) else found


def user_id_diagnostics(order_fact: DataFrame) -> DataFrame:
    """Anonymous and identified orders, and the number of identified users, as one row."""
    user = F.col("USER_ID")
    return order_fact.agg(
        F.count_if(user.isNull()).alias("NULL_USER_ORDERS"),
        F.count_if(user.isNotNull() & ~is_identified(user)).alias("BLANK_USER_ORDERS"),
        F.count_if(is_identified(user)).alias("CUSTOMER_ORDERS"),
        F.count_distinct(F.when(is_identified(user), F.trim(user))).alias("CUSTOMERS"),
    )


def rfm_segment_counts(rfm: DataFrame) -> DataFrame:
    counts = rfm.groupBy("RFM_SEGMENT").agg(F.count(F.lit(1)).alias("USER_COUNT"))
    return counts.orderBy(F.desc("USER_COUNT"), "RFM_SEGMENT")


def require_none(found: dict[str, int], table: str) -> dict[str, int]:
    broken = {rule: count for rule, count in found.items() if count}
    if broken:
        raise QualityError(f"{table}: {broken}")
    return found


def enforce(checks: DataFrame, table: str) -> dict[str, int]:
    """Run the checks; raise when any of them found a violation. Reads one row per rule."""
    return require_none({row["RULE"]: row["VIOLATIONS"] for row in checks.collect()}, table)


def enforce_rows(
    df: DataFrame,
    rules: dict[str, Column],
    table: str,
    reported: dict[str, Column] | None = None,
    identity: Sequence[str] | None = None,
) -> dict[str, int]:
    """The row count and all rules from one pass; raise on violations of ``rules``, only count ``reported``.

    With ``identity`` the same pass counts ``REPEATED_DIGESTS``: digests of these columns that several rows share. Only digests and
    counts travel. Equal rows share one, so none repeated means that there are no copies; the reverse does not hold.
    """
    counted = rules | (reported or {})
    counts = [F.count(F.lit(1)).alias("ROWS"), *[F.count_if(condition).alias(rule) for rule, condition in counted.items()]]
    if identity is None:
        totals = df.agg(*counts)
    else:
        digests = df.groupBy(F.xxhash64(*identity).alias("DIGEST")).agg(*counts)
        sums = [F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in ("ROWS", *counted)]
        totals = digests.agg(*sums, F.count_if(F.col("ROWS") > 1).alias("REPEATED_DIGESTS"))
    found = totals.first().asDict()
    require_none({rule: found[rule] for rule in rules}, table)
    return found


def assert_row_count(observed: int, expected: int, table: str) -> None:
    if observed != expected:
        raise QualityError(f"{table}: expected {expected} rows, found {observed}")
