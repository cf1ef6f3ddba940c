"""Pages of sorted tables, order sets, clustered marts and footers."""

from __future__ import annotations

import random
import re
from datetime import date, timedelta
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from builders import ITEM_SCHEMA, OPTION_SCHEMA, item
from pyspark.sql import functions as F

from order_analytics.plans import order_sets
from order_analytics.plans.dataset import OrderDataset
from order_analytics.sources import clustered, footers, pages


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def sorted_table(frame, tmp_path):
    draw = random.Random(5)
    rows = [(draw.choice([None, 1, 2, 3, 50]), f"u{k:03d}", k) for k in range(200)]
    df = frame(rows, "V int, ID string, N int").repartition(5)
    keys = (pages.Key("V", descending=True), pages.Key("ID"))
    order = sorted(rows, key=lambda row: (row[0] is None, -(row[0] or 0), row[1]))
    return pages.write(df, keys, str(tmp_path / "t"), files=6), order


def test_pages_equal_slices(sorted_table):
    table, order = sorted_table
    assert table.rows == 200 and len(table.files) > 2
    for number, size in ((0, 7), (3, 31), (28, 7), (29, 7), (0, 500)):
        page = table.page(number, size)
        assert [tuple(row) for row in page.collect()] == order[number * size : (number + 1) * size]


def test_a_page_opens_the_files_it_lies_in(sorted_table):
    table, _ = sorted_table
    assert len({Path(file).parent for file in table.page(0, 3).inputFiles()}) == 1
    assert len({Path(file).parent for file in table.page(0, 200).inputFiles()}) == len(table.files)


def test_the_page_after_a_key(sorted_table):
    table, order = sorted_table
    ranks = [(row[0] is None, -(row[0] or 0), row[1]) for row in order]
    for values in ((50, ""), (50, "u100"), (3, "zzz"), (4, "a"), (None, "u050"), (None, "zzz"), (99, "")):
        rank = (values[0] is None, -(values[0] or 0), values[1])
        expected = [row for row, place in zip(order, ranks, strict=True) if place > rank][:9]
        assert [tuple(row) for row in table.after(values, 9).collect()] == expected, values


def test_an_empty_sorted_table(frame, tmp_path):
    table = pages.write(frame([], "V int, ID string"), (pages.Key("ID"),), str(tmp_path / "t"), files=3)
    assert table.rows == 0 and table.page(0, 5).count() == 0 and table.after(("a",), 5).count() == 0


def test_order_sets_count_distinct_orders(frame):
    draw = random.Random(2)
    lines = [
        item(f"O{k % 80}", f"L{k}", f"R{k % 80 % 3}", f"2024-0{1 + k % 80 % 4}-03 10:00:00", category=draw.choice(["A", "B", "C", None]))
        for k in range(300)
    ]
    data = OrderDataset(frame(lines, ITEM_SCHEMA), frame([], OPTION_SCHEMA))
    numbers = order_sets.numbered_orders(data.order_categories.filter("LEADS_ORDER"), data.stage).select("ORDER_NUMBER").collect()
    assert sorted(row[0] for row in numbers) == list(range(1, 81))
    month = F.trunc("PERIOD_START_DATE", "month").alias("MONTH")
    for chosen in (None, ["A"], ["A", "C"], ["A", "B", "C"], []):
        found = {(r["MONTH"].month, r["RESTAURANT_ID"]): r["ORDER_COUNT"] for r in order_sets.order_counts(data.order_sets, [month, "RESTAURANT_ID"], chosen).collect()}
        expected: dict = {}
        for line in lines:
            if chosen is None or line[6] in chosen:
                expected.setdefault((line[3].month, line[2]), set()).add(line[0])
        assert found == {key: len(orders) for key, orders in expected.items()}
    total = order_sets.order_counts(data.order_sets, [], ["A", "B"]).first()["ORDER_COUNT"]
    assert total == len({line[0] for line in lines if line[6] in ("A", "B")})
    data.release()


def groups_read(folder: Path, name: str, low, high) -> tuple[int, int]:
    """Row groups whose extremes let a filter through, and all."""
    read = total = 0
    for file in folder.glob("*.parquet"):
        held = pq.ParquetFile(file).metadata
        column = held.schema.names.index(name)
        for number in range(held.num_row_groups):
            ends = held.row_group(number).column(column).statistics
            total += 1
            read += ends is None or not (ends.max < low or ends.min > high)
    return read, total


def test_a_filter_on_any_column_reads_few_row_groups(frame, tmp_path):
    draw = random.Random(1)
    rows = [(date(2020, 1, 1) + timedelta(draw.randrange(1000)), f"R{draw.randrange(40):02d}", draw.random()) for _ in range(20_000)]
    df = frame([*rows, (None, None, 1.0)], "DAY date, SHOP string, V double")
    clustered.write(df, ["DAY", "SHOP"], str(tmp_path / "z"), files=32)
    for name, low, high in (("DAY", date(2021, 3, 1), date(2021, 3, 20)), ("SHOP", "R07", "R08")):
        read, total = groups_read(tmp_path / "z", name, low, high)
        assert total >= 20 and 0 < read <= total // 2, (name, read, total)
    stored = frame([], df.schema).sparkSession.read.parquet(str(tmp_path / "z"))
    assert sorted(map(str, stored.collect())) == sorted(map(str, df.collect()))
    assert clustered.cuts(df.filter("false"), ["DAY"]) == {"DAY": []}


def test_footers_answer_without_columns(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    frame([(date(2024, 1, k), k) for k in range(1, 20)], "DAY date, N int").repartition(3).write.parquet(path)
    found = footers.summary(spark, path, ["DAY", "N"])
    assert tuple(found.first()) == (19, date(2024, 1, 1), date(2024, 1, 19), 1, 19)
    plan = plan_of(found)
    assert re.search(r"PushedAggregation: \[(?!\])", plan) and "BatchScan" in plan
    assert footers.row_count(spark, path) == 19


def test_order_numbers_travel_and_not_bitmaps(spark, frame):
    """No exchange stands above a bitmap of 4 KB: each is made where its numbers have met."""
    data = OrderDataset(frame([item(category="A"), item(line="L2", category="B")], ITEM_SCHEMA), frame([], OPTION_SCHEMA))
    staged = data.order_categories

    class Unstaged(type(data.stage)):
        def keep(self, df, label):
            return df

    plan = order_sets.order_sets(staged, Unstaged(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan[: plan.index("partial_bitmap_construct_agg")]
