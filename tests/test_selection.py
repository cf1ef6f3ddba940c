"""Places of a sorted column, found by counts."""

from __future__ import annotations

import random
from decimal import Decimal

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from order_analytics import registry
from order_analytics.operators import selection
from order_analytics.operators.selection import Found, Wanted, text_at, values_at


@pytest.mark.parametrize("ranges", [16, 1024])
def test_values_at_equal_a_sort(frame, monkeypatch, ranges):
    monkeypatch.setattr(selection, "RANGES", ranges)
    draw = random.Random(3)
    cents = [draw.choice([0, 0, 5, draw.randrange(-300, 300), draw.randrange(10**13)]) for _ in range(150)] + [None] * 3 + [-(10**27), 10**27 + 1]
    df = frame([(None if c is None else Decimal(c).scaleb(-2), c is not None and c % 2 == 0) for c in cents], "V decimal(30,2), EVEN boolean")
    every = lambda total: [1, 2, 3, 4, 5, total // 3, total // 2, total - 1, total, total + 1]
    found, sizes = values_at(df, "V", {"all": Wanted(every), "even": Wanted(every, F.col("EVEN")), "none": Wanted(every, F.lit(None))})
    for name, held in (("all", cents), ("even", [c for c in cents if c is not None and c % 2 == 0]), ("none", [])):
        order = sorted(held, key=lambda c: (c is not None, c or 0))
        assert sizes[name] == len(order)
        for place, one in zip(every(len(order)), found[name], strict=True):
            if not 1 <= place <= len(order):
                assert one is None
                continue
            value = order[place - 1]
            assert one == Found(None if value is None else Decimal(value).scaleb(-2), place - order.index(value))


def test_values_of_integers_and_nothing(frame):
    found, sizes = values_at(frame([(7,), (2**62,), (-(2**62),)], "V bigint"), "V", {"all": Wanted(lambda total: [1, 2, 3])})
    assert [one.value for one in found["all"]] == [-(2**62), 7, 2**62] and sizes == {"all": 3}
    assert values_at(frame([], "V int"), "V", {"all": Wanted(lambda total: [1])}) == ({"all": [None]}, {"all": 0})
    with pytest.raises(TypeError):
        values_at(frame([(1.0,)], "V double"), "V", {"all": Wanted(lambda total: [1])})


@pytest.mark.parametrize("few", [0, 1000])
def test_text_at(frame, monkeypatch, few):
    monkeypatch.setattr(selection, "FEW", few)
    texts = ["", "a", "ab", "abc", "abcd", "é", "éa", "\U0001f600", "b", "ba", "zz", "aé"]
    df = frame([(text,) for text in texts], "T string")
    order = sorted(texts, key=str.encode)
    assert [text_at(df, "T", place) for place in range(1, len(order) + 1)] == order
    with pytest.raises(IndexError):
        text_at(df, "T", len(order) + 1)


def test_revenues_are_neither_sorted_nor_copied(spark, monkeypatch):
    registry.close_all(spark)
    data = registry.dataset(spark, SMALL)
    data.profile.count()
    monkeypatch.setattr("order_analytics.operators.staging.write_table", lambda *_: pytest.fail("a staged copy"))
    for name in ("customer_clv", "clv_kpis", "clv_histogram"):
        plan = registry.queries()[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
        assert "rangepartitioning(LIFETIME_REVENUE" not in plan
    registry.close_all(spark)
