"""Snapshot versions, sync, mart store and the whole pipeline."""

from __future__ import annotations

from datetime import UTC, date, datetime

import pytest
from builders import OPTION_SCHEMA, option
from conftest import SMALL
from pyspark.sql import functions as F

from order_analytics import registry, session
from order_analytics.operators import quality, sync
from order_analytics.plans import pipeline
from order_analytics.schemas import ORDER_ITEM_OPTIONS
from order_analytics.sources import fixtures, jdbc, mart_store, snapshots

SPEC = ORDER_ITEM_OPTIONS
NOW = datetime(2024, 9, 1, tzinfo=UTC)


@pytest.fixture
def options(frame):
    def build(*rows, hour=0):
        df = frame(list(rows), OPTION_SCHEMA)
        return snapshots.add_lineage(df, NOW.replace(hour=hour), "options", "FULL_DAILY")

    return build


def counts(summary):
    return [summary[f"{action}_ROWS"] for action in sync.ACTIONS]


def test_sync_inserts_updates_deletes(spark, options, tmp_path):
    path = str(tmp_path / "t")
    first = sync.sync(spark, path, options(option(line="A"), option(line="B")), SPEC)
    assert counts(first) == [2, 0, 0, 0] and first["VERSION"] == 1
    changed = options(option(line="B", price=9), option(line="C"), option(line="D"), hour=1)
    second = sync.sync(spark, path, changed, SPEC, compare=SPEC.business_columns)
    assert counts(second) == [2, 1, 1, 0] and second["VERSION"] == 2
    stored = snapshots.read_current(spark, path, SPEC.schema)
    assert sorted(map(str, stored.collect())) == sorted(map(str, changed.collect()))


def test_sync_without_changes_keeps_the_version(spark, options, tmp_path):
    path = str(tmp_path / "t")
    rows = [option(line="A"), option(line="B")]
    sync.sync(spark, path, options(*rows), SPEC)
    again = sync.sync(spark, path, options(*rows, hour=5), SPEC, compare=SPEC.business_columns)
    assert counts(again) == [0, 0, 0, 2] and again["VERSION"] == 1
    assert snapshots.current_version(spark, path) == 1
    everything = sync.sync(spark, path, options(*rows, hour=5), SPEC)
    assert counts(everything) == [0, 2, 0, 0] and everything["VERSION"] == 2


def test_sync_to_an_empty_source(spark, options, tmp_path):
    path = str(tmp_path / "t")
    sync.sync(spark, path, options(option()), SPEC)
    assert counts(sync.sync(spark, path, options(), SPEC)) == [0, 0, 1, 0]
    assert snapshots.read_current(spark, path, SPEC.schema).count() == 0


def test_conflicting_source_is_not_published(spark, options, tmp_path):
    path = str(tmp_path / "t")
    sync.sync(spark, path, options(option()), SPEC)
    with pytest.raises(quality.QualityError, match="DUPLICATE_KEY"):
        sync.sync(spark, path, options(option(price=1), option(price=2)), SPEC)
    assert snapshots.current_version(spark, path) == 1
    assert sync.sync(spark, path, options(option(price=3)), SPEC)["VERSION"] == 2


def test_null_keys_do_not_match(frame):
    rows = frame([(None, 1)], "K string, V int")
    actions = {row["ACTION"] for row in sync.snapshot_changes(rows, rows, ["K"]).collect()}
    assert actions == {"INSERT", "DELETE"}


def test_unchanged_compares_null_safely(frame):
    old, new = frame([("a", None), ("b", None)], "K string, V int"), frame([("a", None), ("b", 1)], "K string, V int")
    found = {row["K"]: row["ACTION"] for row in sync.snapshot_changes(old, new, ["K"], ["K", "V"]).collect()}
    assert found == {"a": "UNCHANGED", "b": "UPDATE"}


def test_compared_columns_travel_as_digests(frame):
    """Digests agree where the columns do: on zeros of either sign, NaN and NULLs in the same place. Types that differ are compared themselves."""
    schema = "K int, F float, S string, T string"
    old = [(1, 0.0, "a", None), (2, float("nan"), None, None), (3, 1.0, "a", None), (4, 1.0, "", "b"), (5, None, "x", "y"), (6, 2.0, "x", "y")]
    new = [(1, -0.0, "a", None), (2, float("nan"), None, None), (3, 1.0, None, "a"), (4, 1.0, None, "b"), (5, None, "x", "y"), (7, 2.0, "x", "y")]
    expected = {1: "UNCHANGED", 2: "UNCHANGED", 3: "UPDATE", 4: "UPDATE", 5: "UNCHANGED", 6: "DELETE", 7: "INSERT"}
    before, after = frame(old, schema), frame(new, schema)
    for source in (after, after.withColumn("F", F.col("F").cast("double"))):
        changes = sync.snapshot_changes(before, source, ["K"], ["K", "F", "S", "T"])
        assert {row["K"]: row["ACTION"] for row in changes.collect()} == expected
    changes = sync.snapshot_changes(before, after, ["K"], ["F", "S", "T"])
    assert changes._jdf.queryExecution().executedPlan().toString().count("xxhash64(") == 4


def test_lines_of_the_compared_snapshots_are_joined_once(spark, monkeypatch):
    joined, lines = [], fixtures._lines
    monkeypatch.setattr(fixtures, "_lines", lambda *given, **narrowed: joined.append(given) or lines(*given, **narrowed))
    assert registry.queries()["snapshot_sync_changes"](spark, SMALL).count() > 0
    assert len(joined) == 1


def test_missing_snapshot(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        snapshots.read_current(spark, str(tmp_path / "none"))


def test_mart_store(frame, spark, tmp_path):
    df, root = frame([(1,), (2,)], "N int"), str(tmp_path)
    assert mart_store.write_mart(df, root, 1, "customer_clv", date(2024, 8, 31), NOW) == 2
    with pytest.raises(FileNotFoundError):
        mart_store.read_mart(spark, root, "customer_clv")
    snapshots.publish(spark, root, 1)
    mart_store.write_mart(df.limit(1), root, 2, "customer_clv", date(2024, 9, 1), NOW)
    stored = mart_store.read_mart(spark, root, "customer_clv")
    assert stored.columns == ["N", "_GENERATED_AT", "_ANALYSIS_DATE"]
    assert {row["_ANALYSIS_DATE"] for row in stored.collect()} == {date(2024, 8, 31)}
    with pytest.raises(ValueError):
        mart_store.read_mart(spark, str(tmp_path), "customers")
    with pytest.raises(FileNotFoundError):
        mart_store.read_mart(spark, str(tmp_path), "customer_rfm")


def test_unknown_load_type(spark, tmp_path):
    with pytest.raises(ValueError):
        pipeline.snapshot_tables({}, str(tmp_path), "PARTIAL", pipeline.RunSummary())


def test_jdbc_bounds_query():
    assert jdbc.bounds_query("t", "c") == "(SELECT MIN(c) AS LOWEST, MAX(c) AS HIGHEST FROM t) bounds"


def test_pipeline_writes_marts_that_reconcile(spark, tmp_path):
    root = str(tmp_path)
    summary = pipeline.run(spark, raw_sources(spark), root, "FULL_INITIAL")
    values = {(row["STEP"], row["TABLE"], row["METRIC"]): row["VALUE"] for row in summary.collect()}
    assert values["sync", "order_items", "INSERT_ROWS"] == 6000
    assert values["mart", "customer_rfm", "ROWS"] == values["profile", "orders", "CUSTOMERS"] == 144
    assert {values["profile", "customer_rfm", name] for name in ("VIP", "NEW_CUSTOMER")} == {16, 12}

    def revenue(name):
        mart = mart_store.read_mart(spark, f"{root}/marts", name)
        return mart.agg(F.sum("TOTAL_REVENUE")).first()[0]

    totals = {revenue(name) for name in mart_store.MARTS if name.startswith(("sales", "restaurant", "discount"))}
    assert len(totals) == 1


def raw_sources(spark):
    lineage = ["_ingested_at", "_source table", "_Load-Type"]
    made = {"date_dim": fixtures.raw_date_dim, "order_item_options": fixtures.raw_options, "order_items": fixtures.raw_order_items}
    return {name: build(spark, SMALL).drop(*lineage) for name, build in made.items()}


def test_equal_second_run_changes_nothing_and_a_failed_gate_keeps_the_marts(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    pipeline.run(spark, raw_sources(spark), root)
    again = pipeline.run(spark, raw_sources(spark), root)
    values = {(row["STEP"], row["TABLE"], row["METRIC"]): row["VALUE"] for row in again.collect()}
    for name in pipeline.TABLES:
        assert values["sync", name, "UNCHANGED_ROWS"] == values["sync", name, "FINAL_ROWS"] > 0
        assert values["sync", name, "VERSION"] == 1 == snapshots.current_version(spark, f"{root}/typed/{name}")
        assert values["sync", name, "EXACT_DUPLICATES"] == 0
    assert snapshots.current_version(spark, f"{root}/marts") == 2

    monkeypatch.setattr(quality, "span_rules", lambda: {"ALWAYS": F.lit(True)})
    with pytest.raises(quality.QualityError, match="ALWAYS"):
        pipeline.build_marts(spark, f"{root}/typed", f"{root}/marts", pipeline.RunSummary())
    assert snapshots.current_version(spark, f"{root}/marts") == 2
    assert not snapshots.exists(spark, snapshots.version_path(f"{root}/marts", 3))
    assert mart_store.read_mart(spark, f"{root}/marts", "customer_rfm").count() == 144


def test_old_versions_are_retired(spark, options, tmp_path):
    path = str(tmp_path / "t")
    for price in range(4):
        sync.sync(spark, path, options(option(price=price)), SPEC)
    snapshots.write_candidate(options(option(price=9)), path)
    assert sorted(snapshots.retire(spark, path, keep=2)) == [1, 2]
    assert snapshots.current_version(spark, path) == 4
    assert not snapshots.exists(spark, snapshots.version_path(path, 1))
    assert snapshots.exists(spark, snapshots.version_path(path, 5))


def test_shuffle_partitions_follow_the_input(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        assert session.size_shuffles(spark, 1000) == max(8, int(before))
        assert session.size_shuffles(spark, 10**14) == -(-4 * 10**14 // session.TARGET_PARTITION_BYTES)
        assert session.size_shuffles(spark, 1000) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_pipeline_stops_at_a_broken_gate(spark, tmp_path):
    raw = fixtures.flawed_order_items(spark, SMALL).drop("_ingested_at", "_source table", "_Load-Type")
    summary = pipeline.RunSummary()
    pipeline.snapshot_tables({"order_items": raw}, f"{tmp_path}/raw", "FULL_DAILY", summary)
    stored = snapshots.read_current(spark, f"{tmp_path}/raw/order_items")
    with pytest.raises(quality.QualityError, match="CAST_CREATION_TIME_UTC"):
        pipeline.conform_table(stored, pipeline.TABLES["order_items"], summary)


def test_keys_are_checked_where_they_meet_the_target(spark, frame):
    """The figures of the key check and of the changes, NULL and repeated keys included, from one exchange of each side."""
    old = frame([("a", 1), ("b", 2), (None, 3)], "K string, V int")
    new = frame([("b", 2), ("c", 3), ("c", 4), (None, 3)], "K string, V int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        changes = sync.keyed_changes(old, new, ["K"])
        plan = changes._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 2
    assert changes.first().asDict() == {
        "INSERT_ROWS": 2, "UPDATE_ROWS": 1, "DELETE_ROWS": 2, "UNCHANGED_ROWS": 0, "TARGET_ROWS": 3, "FINAL_ROWS": 3, "ROWS": 4, "DUPLICATE_KEYS": 1,
    }
