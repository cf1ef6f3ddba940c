"""Splits of a scan by a text key; the predicates are also Spark's, so they are tried on a table of Spark."""

from __future__ import annotations

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from order_analytics.sources import jdbc

KEYS = ["", "O1", "O10", "O2", "O'5", "o9", "é", "zz", None, None, "O1"]


@pytest.mark.parametrize("cuts", [[], ["O10"], ["O1", "O2", "é"], ["", "O'5"], ["zzz"]])
def test_ranges_cover_the_table_and_are_disjoint(frame, cuts):
    df = frame([(key, number) for number, key in enumerate(KEYS)], "ORDER_ID string, N int")
    parts = [df.filter(predicate).select("N").collect() for predicate in jdbc.key_ranges("ORDER_ID", cuts)]
    assert len(parts) == len(cuts) + 1
    assert sorted(row["N"] for part in parts for row in part) == list(range(len(KEYS)))
    assert {8, 9} <= {row["N"] for row in parts[0]}


@settings(max_examples=30, deadline=None)
@given(st.lists(st.text(st.characters(codec="ascii", exclude_characters="\x00"), max_size=4), max_size=30), st.integers(1, 9))
def test_cuts_of_a_source(keys, parts):
    """The query runs on a source in this process; the ranges of its cuts hold every row once and are even."""
    connection = duckdb.connect()
    connection.execute("CREATE TABLE order_items (ORDER_ID VARCHAR, N INT)")
    for number, key in enumerate([*keys, None]):
        connection.execute("INSERT INTO order_items VALUES (?, ?)", [key, number])
    split = jdbc.KeySplit("ORDER_ID", parts, 4)
    found = connection.execute(f"SELECT TILE, CUT FROM {jdbc.cuts_query('order_items', split)} ORDER BY TILE").fetchall()
    ranges = jdbc.key_ranges("ORDER_ID", [cut for _, cut in found])
    held = [connection.execute(f"SELECT N, ORDER_ID FROM order_items WHERE {predicate}").fetchall() for predicate in ranges]
    assert sorted(n for part in held for n, _ in part) == list(range(len(keys) + 1))
    sizes = [len({key for _, key in part if key is not None}) for part in held]
    assert len(ranges) == max(1, min(parts, len(set(keys)))) and max(sizes) - min(sizes) <= 1


def test_a_failed_lot_is_read_again_alone(spark, frame, tmp_path):
    df = frame([(f"O{k:03d}", k) for k in range(50)], "ORDER_ID string, N int")
    predicates = jdbc.key_ranges("ORDER_ID", ["O010", "O020", "O030", "O040"])
    asked, fails = [], {"O020"}

    def read(lot):
        asked.append(len(lot))
        broken = any(key in predicate for key in fails for predicate in lot[1:])
        rows = df.filter(" OR ".join(f"({predicate})" for predicate in lot))
        return rows.withColumn("N", F.expr("raise_error('lost')").cast("int")) if broken else rows

    folder = str(tmp_path / "landed")
    with pytest.raises(Exception, match="lost"):
        jdbc.land_by_key(spark, folder, predicates, 2, read)
    fails.clear()
    landed = jdbc.land_by_key(spark, folder, predicates, 2, read)
    assert asked == [2, 2, 2, 1]
    assert sorted(row["N"] for row in landed.collect()) == list(range(50))
