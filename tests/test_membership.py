"""Rows inside and outside many ids, and changes told by digests of groups."""

from __future__ import annotations

from conftest import SMALL
from pyspark.sql import functions as F

from order_analytics import registry
from order_analytics.operators import membership, sync
from order_analytics.operators.staging import Stage

ROWS = "G string, K int, V string"


def plain(df):
    return sorted(map(str, df.collect()))


def test_inside_and_split_equal_joins(spark, frame, monkeypatch):
    monkeypatch.setattr(membership, "BITS", 64)  # so that most bits are those of some other row too
    stage = Stage(spark)
    rows = frame([(None if n % 7 == 0 else f"g{n % 50}", n % 20, "v") for n in range(200)], ROWS)
    members = membership.keep(frame([(f"g{n}",) for n in range(0, 60, 3)], "G string"), stage)
    among = F.col("G").isin([f"g{n}" for n in range(0, 60, 3)])
    assert plain(membership.inside(rows, members, F.col("G"))) == plain(rows.filter(among))
    inner, outer = membership.split(rows, members, F.col("G"), stage)
    assert plain(inner) == plain(rows.filter(among))
    assert plain(outer) == plain(rows.filter(~F.coalesce(among, F.lit(False))))
    stage.release()


def test_no_ids_have_no_rows(spark, frame):
    stage = Stage(spark)
    rows = frame([("a", 1, "v"), (None, 2, "w")], ROWS)
    members = membership.keep(frame([], "G string"), stage)
    assert membership.inside(rows, members, F.col("G")).count() == 0
    assert [part.count() for part in membership.split(rows, members, F.col("G"), stage)] == [0, 2]
    stage.release()


def test_changes_by_group_equal_changes_by_row(spark, frame):
    stage = Stage(spark)
    old = frame([(f"g{n // 4}", n, None if n % 3 == 0 else f"v{n}") for n in range(80)], ROWS)
    changed = {3: None, 8: "w", 9: "v10", 10: "v9", 41: ""}  # two lines of an order change places
    new = frame([(f"g{n // 4}", n, changed.get(n, None if n % 3 == 0 else f"v{n}")) for n in range(80) if n not in (20, 21)] + [("new", 0, "v"), (None, 1, "v")], ROWS)
    key, compare = ["G", "K"], ["G", "K", "V"]
    by_row = sync.changed_rows(old, new, key, compare)
    by_group = sync.changed_rows(old, new, key, compare, "G", stage)
    assert plain(by_group) == plain(by_row) and by_group.count() == 8
    stage.release()


def test_a_mart_refresh_joins_its_lines_once(spark, monkeypatch):
    """The two snapshots are made of lines that were joined and written once."""
    from order_analytics.sources import fixtures

    joins, join = [], fixtures._lines
    monkeypatch.setattr(fixtures, "_lines", lambda *a, **narrowed: joins.append(narrowed) or join(*a, **narrowed))
    registry.queries()["mart_refresh"](spark, SMALL)
    assert len(joins) == 1
