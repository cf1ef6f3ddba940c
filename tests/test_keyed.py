"""Tables laid out by key: the work on keys needs no exchange."""

from __future__ import annotations

import re

import pytest
from conftest import SMALL

from order_analytics import registry
from order_analytics.operators import conform
from order_analytics.plans import facts
from order_analytics.schemas import ORDER_ITEMS
from order_analytics.sources import fixtures, keyed


@pytest.fixture
def shuffled_joins(spark):
    """Small tables are not broadcast, as large ones would not be."""
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    session = keyed.key_session

    def without_broadcasts(spark):
        own = session(spark)
        for name in names:
            own.conf.set(name, "-1")
        return own

    return without_broadcasts


def test_no_exchange_above_the_scans(spark, shuffled_joins, monkeypatch):
    monkeypatch.setattr(keyed, "key_session", shuffled_joins)
    tables = registry._keyed_tables(spark, SMALL)
    for step, df in registry.keyed_work(tables).items():
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not re.search(r"hashpartitioning|rangepartitioning|BroadcastExchange", plan), f"{step}: {plan}"
        assert "Bucketed: true" in plan
    assert "SortMergeJoin" in registry.keyed_work(tables)["MERGE"]._jdf.queryExecution().executedPlan().toString()


def test_a_table_is_read_by_another_session(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    layout = keyed.Layout(("A", "B"), ("A", "B", "C"), 4)
    rows = [(k % 7, k % 3, k) for k in range(100)]
    keyed.write(frame(rows, "A int, B int, C int"), path, layout)
    assert 1 <= len(list((tmp_path / "t").glob("*.parquet"))) <= 4
    spark.sql(f"DROP TABLE {keyed.table_name(path)}")
    again = keyed.read(keyed.key_session(spark), path, "A int, B int, C int", layout)
    assert sorted(tuple(row) for row in again.collect()) == sorted(rows)
    grouped = again.groupBy("A", "B", "C").count()
    assert "hashpartitioning" not in grouped._jdf.queryExecution().executedPlan().toString()
    keyed.drop(spark, path)
    assert not (tmp_path / "t").exists()


def test_rows_travel_once_to_be_deduplicated_and_laid_out(spark, frame, monkeypatch):
    rows = [(k % 50, k % 5, str(k % 10), (0.0, -0.0, float("nan"), None)[k % 4]) for k in range(400)] + [(7, 7, None, 1.0)] * 60
    df = frame(rows, "A int, B int, S string, F float").repartition(3)
    whole = sorted(map(str, df.dropDuplicates().collect()))
    placed = conform.drop_exact_duplicates(df, placed=(4, ["A", "B"]))
    assert sorted(map(str, placed.collect())) == whole
    assert placed.repartition(4, "A", "B")._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    monkeypatch.setattr(conform, "MANY_COPIES", 50)  # the row that comes 60 times collapses ahead
    apart = conform.drop_exact_duplicates(df, placed=(4, ["A", "B"]))
    assert sorted(map(str, apart.collect())) == whole
    assert apart.select("*")._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 2
    assert apart.rdd.getNumPartitions() == 4


def test_keyed_lines_are_joined_once(spark, monkeypatch):
    joined, lines = [], fixtures._lines
    monkeypatch.setattr(fixtures, "_lines", lambda *given, **narrowed: joined.append(given) or lines(*given, **narrowed))
    assert set(registry._keyed_tables(spark, SMALL)) == {"older", "newer", "options"}
    assert len(joined) == 1


def test_the_order_starts_with_the_bucket_columns():
    with pytest.raises(ValueError, match="start with"):
        keyed.Layout(facts.LINE_KEY, ORDER_ITEMS.key[2:], 4)


def test_buckets_grow_with_the_shuffles_of_the_session(spark):
    """Eight buckets at any size would be tasks that grow with the tables."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        tables = registry._keyed_tables(spark, SMALL)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert {table.rdd.getNumPartitions() for table in tables.values()} == {13}
