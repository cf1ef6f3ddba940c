"""Refreshed marts equal marts built from all rows."""

from __future__ import annotations

import random

from builders import ITEM_SCHEMA, OPTION_SCHEMA, item, option
from conftest import SMALL

from order_analytics.operators import sync
from order_analytics.plans import refresh
from order_analytics.plans.dataset import OrderDataset
from order_analytics.schemas import ORDER_ITEM_OPTIONS, ORDER_ITEMS
from order_analytics.sources import fixtures
from order_analytics.sources.mart_store import MARTS

COLUMNS = [text.split()[0] for text in ITEM_SCHEMA.split(", ")]
COMPARE = [name for name in ORDER_ITEMS.business_columns if name in COLUMNS]


def line(draw, number, month=None):
    """A line of one of 60 orders; an order's restaurant, user and flag follow from its number."""
    order = number % 60
    user = [None, "  ", " u1 ", "u1", *(f"u{k}" for k in range(2, 14))][order % 16]
    loyalty = ["TRUE", "false", None][order % 3]
    month = month or 1 + order % 8
    category = draw.choice(["Pizza", "Drinks", None])
    time = f"2024-{month:02d}-{1 + order % 28:02d} 10:00:{number % 60:02d}"
    return item(f"O{order}", f"L{number}", f"R{order % 5}", time, user, loyalty, category, float(draw.randint(0, 90)), draw.choice([None, 1, 4]))


def compared(frame, state, items, options):
    full = OrderDataset(items, options)
    for name in MARTS:
        one, other = state.mart(name), getattr(full, name)
        assert one.columns == other.columns and one.dtypes == other.dtypes, name
        assert sorted(map(str, one.collect())) == sorted(map(str, other.collect())), name
    assert state.day == full.analysis_date
    full.release()


def test_refreshed_marts_equal_full_ones(frame, monkeypatch):
    monkeypatch.setattr(refresh, "MOST_LAYERS", 2)
    draw = random.Random(7)
    rows = {k: line(draw, k) for k in range(240)}
    extras = {k: option(f"O{k % 60}", f"L{k}", price=k % 3, quantity=k % 4) for k in range(0, 240, 3)}
    tables = lambda: (frame(list(rows.values()), ITEM_SCHEMA), frame(list(extras.values()), OPTION_SCHEMA))
    items, options = tables()
    state = refresh.build(items, options)
    for number in (1, 2):
        for k in draw.sample(sorted(rows), 12):
            rows[k] = line(draw, k)
        for k in [k for k in rows if k % 60 == 9 + number]:  # all lines of an order go, for one the only order of its customer
            del rows[k]
        for k in draw.sample(sorted(extras), 4):
            del extras[k]
        extras[-number] = option("O20", f"L{20 + 60 * number}", price=0, name="new")
        if number == 1:
            rows[300] = line(draw, 300 + 47, month=9)  # moves the analysis date, which takes orders out of windows
        else:
            del rows[300]  # and back
        later_items, later_options = tables()
        changes = [
            sync.changed_rows(items, later_items, ORDER_ITEMS.key, COMPARE),
            sync.changed_rows(options, later_options, ORDER_ITEM_OPTIONS.key, ORDER_ITEM_OPTIONS.business_columns),
        ]
        state = refresh.refresh(state, later_items, later_options, changes)
        compared(frame, state, later_items, later_options)
        items, options = later_items, later_options
    assert state.layers == 1  # two layers were written as one
    state.release()


def test_no_changes_change_nothing(spark):
    items, options = fixtures.order_items(spark, SMALL), fixtures.order_item_options(spark, SMALL)
    state = refresh.build(items, options)
    changes = [sync.changed_rows(items, items, ORDER_ITEMS.key, ORDER_ITEMS.business_columns)]
    again = refresh.refresh(state, items, options, changes)
    for name, table in state.tables.items():
        assert sorted(map(str, again.tables[name].collect())) == sorted(map(str, table.collect())), name
    again.release()


def test_a_refresh_reads_lines_of_changed_orders_only(frame):
    changed = frame([(None, ("O1",)), (("O2",), None), (("O1",), ("O1",))], "OLD struct<ORDER_ID: string>, NEW struct<ORDER_ID: string>")
    assert sorted(row[0] for row in refresh.changed_orders([changed]).collect()) == ["O1", "O2"]
