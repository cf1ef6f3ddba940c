"""Column names, casts, offset timestamps, duplicates and gates."""

from __future__ import annotations

import math
from datetime import date
from decimal import Decimal

import pytest
from builders import ITEM_SCHEMA, OPTION_SCHEMA, item, option
from conftest import SMALL
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from order_analytics.functions.columns import offset_timestamp, short_id
from order_analytics.operators import conform, quality
from order_analytics.plans import facts, pipeline
from order_analytics.schemas import DATE_DIM, LINEAGE, ORDER_ITEM_OPTIONS, ORDER_ITEMS
from order_analytics.sources import fixtures

RAW_DATE = "`Date Key` string, year string, `Month ` string, WEEK string, `day-of-week` string, is_weekend string," \
           " is_holiday string, `Holiday  Name` string, _ingested_at string, `_source table` string, _LOAD_TYPE string"


def raw_dates(frame, *rows):
    tail = ("Monday", "FALSE", "FALSE", None, "2024-01-01 00:00:00", "date_dim", "FULL_DAILY")
    return conform.normalize_columns(frame([(*row, *tail) for row in rows], RAW_DATE))


def violations(checks):
    return {row["RULE"]: row["VIOLATIONS"] for row in checks.collect()}


@pytest.mark.parametrize(
    "name, expected",
    [("Order Id", "ORDER_ID"), ("_ingested_at", "_INGESTED_AT"), ("__x--y ", "_X_Y"), ("itemPrice", "ITEMPRICE")],
)
def test_upper_snake(name, expected):
    assert conform.upper_snake(name) == expected


def test_clashing_names_fail(frame):
    with pytest.raises(ValueError, match="ORDER_ID"):
        conform.normalize_columns(frame([(1, 2)], "`order id` int, ORDER_ID int"))


def test_closed_schema(frame):
    named = raw_dates(frame, ("2024-01-01", "2024", "1", "1"))
    quality.check_columns(named, DATE_DIM)
    with pytest.raises(quality.QualityError, match="YEAR"):
        quality.check_columns(named.drop("YEAR"), DATE_DIM)
    with pytest.raises(quality.QualityError, match="EXTRA"):
        quality.check_columns(named.withColumn("EXTRA", F.lit(1)), DATE_DIM)


def test_failed_casts_become_null_and_are_counted(frame):
    rows = [("2024-01-01", "2024", "1", "1"), ("no date", "2024", "300", None), ("2024-02-30", "x", "2", "5")]
    cast = conform.cast_to_schema(raw_dates(frame, *rows), DATE_DIM, keep_originals=True)
    found = violations(quality.run_checks(cast, quality.cast_rules(DATE_DIM)))
    assert found == {
        "CAST_DATE_KEY": 2, "CAST_YEAR": 1, "CAST_MONTH": 1, "CAST_WEEK": 0, "CAST__INGESTED_AT": 0
    }
    assert conform.drop_originals(cast).schema.names == DATE_DIM.schema.names
    with pytest.raises(quality.QualityError, match="CAST_MONTH"):
        quality.enforce_rows(cast, quality.cast_rules(DATE_DIM), "date_dim")


def test_small_option_prices_round_half_up(frame):
    schema = "ORDER_ID string, LINEITEM_ID string, OPTION_GROUP_NAME string, OPTION_NAME string, OPTION_PRICE double," \
             " OPTION_QUANTITY int, _INGESTED_AT string, _SOURCE_TABLE string, _LOAD_TYPE string"
    rows = [("O", "L", "g", str(price), price, 1, None, "s", "l") for price in (0.4, 0.5)]
    typed = conform.cast_to_schema(frame(rows, schema), ORDER_ITEM_OPTIONS, keep_originals=True)
    assert {row["OPTION_NAME"]: row["OPTION_PRICE"] for row in typed.collect()} == {"0.4": Decimal(0), "0.5": Decimal(1)}
    counts = quality.enforce_rows(typed, {}, "options", quality.rounding_rules(ORDER_ITEM_OPTIONS))
    assert counts == {"ROWS": 2, "ROUNDED_OPTION_PRICE": 2, "ROUNDED_OPTION_QUANTITY": 0}
    exact = conform.cast_to_schema(frame(rows, schema), ORDER_ITEM_OPTIONS.with_types(OPTION_PRICE=DecimalType(18, 2)))
    assert {str(row["OPTION_PRICE"]) for row in exact.collect()} == {"0.40", "0.50"}


def test_large_item_prices_lose_cents_only_as_float(frame):
    raw = frame([item()], ITEM_SCHEMA).withColumn("ITEM_PRICE", F.lit("16777217.01"))
    lineage = {name: F.lit(None).cast("string") for name in LINEAGE}
    raw = raw.withColumns(lineage | {name: F.lit("x") for name in ("APP_NAME", "PRINTED_CARD_NUMBER", "CURRENCY")})
    exact = ORDER_ITEMS.with_types(ITEM_PRICE=DecimalType(24, 2))
    as_float, as_decimal = (
        conform.cast_to_schema(raw, spec).select(F.col("ITEM_PRICE").cast("decimal(24,2)")).first()[0]
        for spec in (ORDER_ITEMS, exact)
    )
    assert (str(as_float), str(as_decimal)) == ("16777218.00", "16777217.01")


@pytest.mark.parametrize(
    "text, expected",
    [
        ("2026-08-29 12:34:56.1234567 +00:00", "2026-08-29 12:34:56.123456"),
        ("2026-08-29 12:34:56.123456+00:00", "2026-08-29 12:34:56.123456"),
        ("2026-08-29 12:34:56.123 +05:30", "2026-08-29 07:04:56.123"),
        ("2026-08-29 12:34:56 -08:00", "2026-08-29 20:34:56"),
        ("2026-08-29T12:34:56Z", "2026-08-29 12:34:56"),
        (" 2026-08-29T12:34:56.1234567+00:00 ", "2026-08-29 12:34:56.123456"),
        ("2026-08-29", "2026-08-29 00:00:00"),
        ("tomorrow", None),
        ("", None),
        (None, None),
    ],
)
def test_offset_timestamps(frame, text, expected):
    parsed = frame([(text,)], "T string").select(offset_timestamp("T").cast("string").alias("P")).first()["P"]
    assert parsed == expected


@pytest.mark.parametrize(
    "flag, expected", [("true", 1), (" FALSE ", 0), (None, None), ("", None), ("YES", None)]
)
def test_loyalty_words(frame, flag, expected):
    items = facts.with_loyalty_flag(frame([item(loyalty=flag)], ITEM_SCHEMA))
    assert items.first()["LOYALTY_FLAG"] == expected
    assert violations(quality.run_checks(items, quality.loyalty_rules()))["UNEXPECTED_IS_LOYALTY"] == (flag in ("", "YES"))


def test_exact_duplicates_go_and_conflicts_stay(frame):
    rows = [option(), option(), option(quantity=2), option(line="L2")]
    deduplicated = conform.drop_exact_duplicates(frame(rows, OPTION_SCHEMA))
    assert deduplicated.count() == 3
    assert quality.key_summary(deduplicated, ORDER_ITEM_OPTIONS.key).first().asDict() == {"ROWS": 3, "DUPLICATE_KEYS": 1}
    shown = quality.conflicting_records(deduplicated, ORDER_ITEM_OPTIONS.key).collect()
    assert [int(row["OPTION_QUANTITY"]) for row in shown] == [1, 2]


def test_rows_without_copies_are_not_shuffled(frame):
    def conformed(*rows):
        summary = pipeline.RunSummary()
        return pipeline.conform_table(raw_dates(frame, *rows), DATE_DIM, summary), summary.value("conform", "date_dim", "ROWS")

    days = [(f"2024-01-0{day}", "2024", "1", "1") for day in (1, 2, 3)]
    apart, count = conformed(*days)
    assert (count, apart.count()) == (3, 3)
    assert "Exchange" not in apart._jdf.queryExecution().executedPlan().toString()
    copied, count = conformed(*days, days[0], days[0])
    assert (count, copied.count()) == (5, 3)
    assert sorted(copied.collect()) == sorted(apart.collect())
    assert conformed()[1] == 0


def test_counts_beside_digests(frame):
    df = frame([("a", None), ("a", None), (None, "a"), ("b", "x")], "K string, V string")
    rules = {"NO_VALUE": F.col("V").isNull()}
    plain = quality.enforce_rows(df, {}, "t", rules)
    assert quality.enforce_rows(df, {}, "t", rules, identity=["K", "V"]) == plain | {"REPEATED_DIGESTS": 1}
    with pytest.raises(quality.QualityError, match="'NO_VALUE': 2"):
        quality.enforce_rows(df, rules, "t", identity=["K", "V"])
    assert quality.enforce_rows(df.limit(0), rules, "t", identity=["K"]) == {"ROWS": 0, "NO_VALUE": 0, "REPEATED_DIGESTS": 0}


def test_zeros_are_alike_with_and_without_copies(frame):
    df = frame([(1, -0.0), (2, float("nan")), (3, None), (4, 2.5)], "K int, V float")
    for suspected in (True, False):
        found = {row["K"]: row["V"] for row in conform.drop_exact_duplicates(df, suspected).collect()}
        assert (math.copysign(1, found[1]), math.isnan(found[2]), found[3], found[4]) == (1, True, None, 2.5)
    assert quality.enforce_rows(frame([(0.0,), (-0.0,)], "V float"), {}, "t", identity=["V"])["REPEATED_DIGESTS"] == 1


def test_key_counts_are_those_of_the_keys(frame):
    for rows in ([], [("a", None), (None, "a")], [("a", "b"), ("a", "b"), ("c", "d")], [(None, None), (None, None)]):
        keys = frame(rows, "K string, L string")
        assert quality.key_counts(keys, ["K", "L"]) == quality.key_summary(keys, ["K", "L"]).first().asDict()


def test_consistency_is_enforced_by_digest_and_key(frame):
    clean = frame([item(), item(line="L2", user=None), item(restaurant="R2", user="u2")], ITEM_SCHEMA)
    assert set(quality.enforce_order_consistency(clean, "orders").values()) == {0}
    with pytest.raises(quality.QualityError, match="'ORDER_WITH_SEVERAL_USERS': 1}"):
        quality.enforce_order_consistency(frame([item(), item(line="L2", user="u2")], ITEM_SCHEMA), "orders")


def test_key_summary_of_nothing(frame):
    assert quality.key_summary(frame([], OPTION_SCHEMA), ["ORDER_ID"]).first().asDict() == {"ROWS": 0, "DUPLICATE_KEYS": 0}


def test_sample_of_conflicts_is_limited_to_the_first_keys(frame):
    rows = [item(order=f"O{n:02d}", quantity=quantity) for n in range(30) for quantity in (1, 2)]
    shown = quality.conflicting_records(frame(rows, ITEM_SCHEMA), ORDER_ITEMS.key).collect()
    assert sorted({row["ORDER_ID"] for row in shown}) == [f"O{n:02d}" for n in range(20)]
    assert len(shown) == 40


@pytest.mark.parametrize("broken", ["ORDER_ID", "LINEITEM_ID", "RESTAURANT_ID", "CREATION_TIME_UTC"])
def test_null_key_gate(frame, broken):
    items = frame([item()], ITEM_SCHEMA)
    assert violations(quality.run_checks(items, quality.key_rules(ORDER_ITEMS))) == {"NULL_KEY_ORDER_ITEMS": 0}
    flawed = items.withColumn(broken, F.lit(None).cast("string"))
    assert violations(quality.run_checks(flawed, quality.key_rules(ORDER_ITEMS))) == {"NULL_KEY_ORDER_ITEMS": 1}


def test_revenue_and_join_key_gates(frame):
    items = frame([item(), item(price=None), item(order="O2")], ITEM_SCHEMA)
    assert violations(quality.run_checks(items, quality.item_revenue_rules())) == {"NULL_ITEM_PRICE": 1}
    assert violations(quality.count_duplicate_keys(items, facts.LINE_KEY, "K")) == {"K": 1}
    options = frame([option()], OPTION_SCHEMA).withColumn("OPTION_PRICE", F.lit(None).cast("decimal(18,0)"))
    assert violations(quality.run_checks(options, quality.option_revenue_rules())) == {"NULL_OPTION_PRICE_OR_QUANTITY": 1}


def test_consistency_gate_compares_raw_users_and_ignores_null(frame):
    def found(*items):
        return violations(quality.order_consistency_checks(frame(list(items), ITEM_SCHEMA)))

    clean = found(item(), item(line="L2", user=None, loyalty="TRUE"), item(line="L3", loyalty=" true"))
    assert set(clean.values()) == {0}
    assert found(item(), item(line="L2", user="u1 "))["ORDER_WITH_SEVERAL_USERS"] == 1
    assert found(item(loyalty="TRUE"), item(line="L2", loyalty="false"))["ORDER_WITH_SEVERAL_LOYALTY"] == 1
    assert set(found(item(), item(restaurant="R2", user="u2")).values()) == {0}


def test_consistency_gate_takes_one_order_of_many_users(spark):
    users = spark.range(100_000).selectExpr(
        "'O1' AS ORDER_ID", "'R1' AS RESTAURANT_ID", "concat('u', id) AS USER_ID", "CASE WHEN id % 2 = 0 THEN 'TRUE' END AS IS_LOYALTY"
    )
    checks = quality.order_consistency_checks(users)
    assert violations(checks) == {"ORDER_WITH_SEVERAL_USERS": 1, "ORDER_WITH_SEVERAL_LOYALTY": 0}
    plan = checks._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "SortAggregate" not in plan and "Join" not in plan


def test_score_and_span_gates(frame):
    scores = frame([(0, 1, 0, 2), (0, 2, 1, 3)], "FREQUENCY_6M int, F_SCORE int, MONETARY_6M int, M_SCORE int")
    assert violations(quality.run_checks(scores, quality.rfm_rules())) == {
        "ZERO_FREQUENCY_SCORE": 1, "ZERO_MONETARY_SCORE": 1
    }
    spans = frame([(1, 1), (0, 1), (3, -1)], "ACTIVE_CALENDAR_DAYS int, ACTIVE_CALENDAR_WEEKS int")
    assert set(violations(quality.run_checks(spans, quality.span_rules())).values()) == {1}


def test_coerce_and_short_ids(frame):
    df = conform.coerce(frame([("12.5", "2024-01-02"), ("x", "never")], "N string, D string"), ["N", "ABSENT"], ["D"])
    first, second = df.collect()
    assert (first["N"], first["D"].date()) == (12.5, date(2024, 1, 2))
    assert tuple(second) == (None, None)
    ids = frame([("R001",), ("R1",), (None,)], "ID string").select(short_id("ID").alias("S")).collect()
    assert [row["S"] for row in ids] == ["...001", "R1", "N/A"]


def test_options_fixture_matches_the_items(spark):
    items, options = fixtures.order_items(spark, SMALL), fixtures.order_item_options(spark, SMALL)
    assert facts.orphan_options(items, options).count() == 0
    assert quality.key_summary(items, facts.LINE_KEY).first()["DUPLICATE_KEYS"] == 0
    assert quality.key_summary(options, ORDER_ITEM_OPTIONS.key).first()["DUPLICATE_KEYS"] == 0
