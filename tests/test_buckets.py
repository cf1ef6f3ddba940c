"""Snapshots in key buckets: only what changed is read and written."""

from __future__ import annotations

import random
from datetime import UTC, datetime
from pathlib import Path

import pytest
from builders import ITEM_SCHEMA, OPTION_SCHEMA, item, option
from conftest import SMALL
from pyspark.sql import functions as F

from order_analytics import registry
from order_analytics.operators import quality, sync
from order_analytics.plans import pipeline
from order_analytics.schemas import LINEAGE_FIELDS, ORDER_ITEM_OPTIONS, ORDER_ITEMS
from order_analytics.sources import buckets, fixtures, snapshots

SPEC = ORDER_ITEM_OPTIONS
TABLE = buckets.BucketedTable.of(SPEC, 50)


@pytest.fixture
def options(frame):
    def build(rows, hour=0):
        df = frame(list(rows), OPTION_SCHEMA)
        return snapshots.add_lineage(df, datetime(2024, 9, 1, hour, tzinfo=UTC), "options", "FULL_DAILY")

    return build


def counts(summary):
    return [summary[f"{action}_ROWS"] for action in sync.ACTIONS]


def stored(spark, path, *names):
    return sorted(map(str, buckets.read_current(spark, path, SPEC.schema).select(*names or ["*"]).collect()))


def rows_of(count):
    return {k: option(order=f"O{k % 90}", line=f"L{k}", price=k % 7) for k in range(count)}


def test_only_changed_buckets_are_written(spark, options, tmp_path):
    path, rows = str(tmp_path / "t"), rows_of(1500)
    first = buckets.sync(spark, path, options(rows.values()), TABLE)
    assert counts(first) == [1500, 0, 0, 0] and first["BUCKETS_WRITTEN"] == first["BUCKETS"] == 50
    full = str(tmp_path / "full")
    sync.sync(spark, full, options(rows.values()), SPEC)
    draw = random.Random(1)
    for number in range(2, 5):
        for k in draw.sample(sorted(rows), 3):
            rows[k] = option(order=f"O{k % 90}", line=f"L{k}", price=100 + number)
        for k in draw.sample(sorted(rows), 2):
            del rows[k]
        rows[2000 + number] = option(order="new", line=f"N{number}")
        source = options(rows.values(), hour=number)
        found = buckets.sync(spark, path, source, TABLE)
        expected = sync.sync(spark, full, source, SPEC, compare=SPEC.business_columns)
        assert counts(found) == counts(expected) and found["FINAL_ROWS"] == len(rows)
        folders = list(Path(path, f"v={number}", "rows").glob("BUCKET=*"))
        assert len(folders) == found["BUCKETS_WRITTEN"] <= 6
        assert all(len(list(folder.glob("*.parquet"))) == 1 for folder in folders)
        assert stored(spark, path, *SPEC.business_columns) == sorted(map(str, source.select(SPEC.business_columns).collect()))
        changes = buckets.read_changes(spark, path, number, SPEC.schema)
        assert changes.groupBy("ACTION").count().count() == 3 and changes.count() == sum(counts(found)[:3])
    hours = buckets.read_current(spark, path, SPEC.schema).groupBy(F.hour("_INGESTED_AT").alias("H")).count().collect()
    assert max(hours, key=lambda row: row["count"])["H"] == 0  # a row that did not change keeps its lineage


def test_buckets_without_rows_are_not_paired(spark, frame, tmp_path, monkeypatch):
    """A first version, and months that are new, are written as they come: no row of theirs is staged with its pair."""

    def staged(*_):
        raise AssertionError("rows were staged")

    table = buckets.BucketedTable.of(ORDER_ITEMS, 3, period="CREATION_TIME_UTC")
    lineage = {field.name: F.lit(None).cast(field.dataType) for field in LINEAGE_FIELDS}
    blank = {name: F.lit(None).cast("string") for name in ("APP_NAME", "PRINTED_CARD_NUMBER", "CURRENCY")}
    path, names = str(tmp_path / "t"), ORDER_ITEMS.schema.names
    old = [item(order=f"O{k}", time="2024-05-01 10:00:00", user=None) for k in range(40)]
    new = [item(order=f"O{k}", time="2024-06-01 10:00:00", price=None) for k in range(30)]
    monkeypatch.setattr(buckets.staging, "write_table", staged)
    for version, rows, added in ((1, old, old), (2, old + new, new)):
        source = frame(rows, ITEM_SCHEMA).withColumns(blank | lineage).select(names)
        found = buckets.sync(spark, path, source, table)
        assert counts(found) == [len(added), 0, 0, len(rows) - len(added)] and found["BUCKETS_READ"] == 0
        assert sorted(map(str, buckets.read_current(spark, path, ORDER_ITEMS.schema).collect())) == sorted(map(str, source.collect()))
        changes = buckets.read_changes(spark, path, version, ORDER_ITEMS.schema).collect()
        assert {(row["ACTION"], row["OLD"]) for row in changes} == {("INSERT", None)}
        assert sorted(str(row["NEW"]) for row in changes) == sorted(map(str, frame(added, ITEM_SCHEMA).withColumns(blank | lineage).select(names).collect()))


def test_lines_of_both_snapshots_are_joined_once(spark, monkeypatch):
    joined, lines = [], fixtures._lines
    monkeypatch.setattr(fixtures, "_lines", lambda *given, **narrowed: joined.append(given) or lines(*given, **narrowed))
    assert registry.sync_changed_buckets(spark, SMALL).count() > 0
    assert len(joined) == 1


def test_nothing_is_written_without_changes(spark, options, tmp_path):
    path, rows = str(tmp_path / "t"), rows_of(60)
    buckets.sync(spark, path, options(rows.values()), TABLE)
    again = buckets.sync(spark, path, options(rows.values(), hour=5), TABLE)
    assert counts(again) == [0, 0, 0, 60] and (again["VERSION"], again["BUCKETS_READ"], again["BUCKETS_WRITTEN"]) == (1, 0, 0)
    assert snapshots.all_versions(spark, path) == [1]


def test_digests_see_nulls_and_copies(spark, frame):
    schema = "ORDER_ID string, LINEITEM_ID string, OPTION_GROUP_NAME string, OPTION_NAME string, OPTION_PRICE decimal(18,0), OPTION_QUANTITY decimal(18,0)"
    one = buckets.BucketedTable.of(SPEC, 1)
    digest = lambda *rows: buckets._digests(frame(list(rows), schema), one)
    assert digest(("O", "L", "g", None, None, None)) != digest(("O", "L", None, "g", None, None))
    assert digest(("O", "L", "g", "n", None, None)) != digest(*[("O", "L", "g", "n", None, None)] * 2)
    assert digest(("a", "L", "g", "n", None, None), ("b", "L", "g", "n", None, None)) == digest(
        ("b", "L", "g", "n", None, None), ("a", "L", "g", "n", None, None)
    )


def test_empty_snapshots(spark, options, tmp_path):
    path = str(tmp_path / "t")
    assert counts(buckets.sync(spark, path, options([]), TABLE)) == [0, 0, 0, 0]
    assert stored(spark, path) == []
    assert counts(buckets.sync(spark, path, options([option()]), TABLE)) == [1, 0, 0, 0]
    assert counts(buckets.sync(spark, path, options([]), TABLE)) == [0, 0, 1, 0]
    assert stored(spark, path) == []
    assert counts(buckets.sync(spark, path, options([option()]), TABLE)) == [1, 0, 0, 0]


def test_conflicting_keys_leave_the_version(spark, options, tmp_path):
    path = str(tmp_path / "t")
    buckets.sync(spark, path, options([option()]), TABLE)
    with pytest.raises(quality.QualityError, match="DUPLICATE_KEY"):
        buckets.sync(spark, path, options([option(price=1), option(price=2)]), TABLE)
    assert snapshots.all_versions(spark, path) == [1]


def test_old_folders_are_rewritten_and_removed(spark, options, tmp_path, monkeypatch):
    monkeypatch.setattr(buckets, "MOST_VERSIONS", 3)
    path, rows = str(tmp_path / "t"), rows_of(120)
    table = buckets.BucketedTable.of(SPEC, 8)
    for number in range(1, 6):
        rows[0] = option(order="O0", line="L0", price=number)
        buckets.sync(spark, path, options(rows.values()), table)
        live = {entry.version for entry in buckets.manifest(spark, path, number).values()}
        assert len(live) <= 3
        buckets.retire(spark, path, 1)
        assert stored(spark, path, *SPEC.business_columns) == sorted(map(str, options(rows.values()).select(SPEC.business_columns).collect()))
        assert {int(folder.name.removeprefix("v=")) for folder in Path(path).glob("v=*")} == live | {number}
    assert snapshots.published_versions(spark, path) == [5]


def test_a_period_must_be_part_of_the_key():
    with pytest.raises(ValueError, match="no part of the key"):
        buckets.BucketedTable.of(SPEC, 4, period="OPTION_PRICE")


def test_the_pipeline_rewrites_only_buckets_that_changed(spark, tmp_path):
    lineage = ["_ingested_at", "_source table", "_Load-Type"]
    made = {"date_dim": fixtures.raw_date_dim, "order_item_options": fixtures.raw_options, "order_items": fixtures.raw_order_items}
    sources = {name: build(spark, SMALL).drop(*lineage) for name, build in made.items()}
    raw, typed = f"{tmp_path}/raw", f"{tmp_path}/typed"
    late = F.col("Creation Time Utc").startswith("2001-07")
    for number in (1, 2):
        summary = pipeline.RunSummary()
        if number == 2:
            sources["order_items"] = sources["order_items"].filter(~late)
        pipeline.snapshot_tables(sources, raw, "FULL_DAILY", summary)
        pipeline.conform_tables(spark, raw, typed, summary, key_buckets=2)
    value = lambda table, metric: summary.value("sync", table, metric)
    assert value("order_items", "DELETE_ROWS") > 0 and 0 < value("order_items", "BUCKETS_READ") <= 2
    assert value("order_items", "BUCKETS") > 100 and value("order_items", "BUCKETS_WRITTEN") == 0
    assert [value(name, "BUCKETS_READ") for name in ("date_dim", "order_item_options")] == [0, 0]
    items = pipeline.read_typed(spark, typed, ORDER_ITEMS, key_buckets=2)
    expected = fixtures.order_items(spark, SMALL).filter("date_format(CREATION_TIME_UTC, 'yyyy-MM') <> '2001-07'")
    assert items.exceptAll(expected.select(items.columns)).count() == 0 and items.count() == expected.count()
