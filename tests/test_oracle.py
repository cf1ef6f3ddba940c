"""Every registered query equals its SQL on the smallest test tables."""

from __future__ import annotations

import pytest
from conftest import SMALL
from oracle_check import connect, differences

import __spark_entry__ as contract
from order_analytics import registry

QUERIES, SQL = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def tables():
    return connect(SMALL)


def test_every_query_of_the_library_has_sql():
    assert set(registry.queries()) <= set(SQL)


@pytest.mark.parametrize("name", registry.queries())
def test_query_equals_sql(spark, tables, name):
    assert differences(QUERIES[name](spark, SMALL), SQL[name], tables) is None


def test_entry_returns_rows(spark):
    assert contract.entry(spark).limit(1).count() == 1


def test_datasets_stay_readable_until_they_are_closed(spark):
    registry.close_all(spark)
    folders = [SMALL + "/" * extra for extra in range(7)]
    first = registry.dataset(spark, folders[0])
    profile = first.profile
    rows = profile.count()
    for folder in folders[1:]:
        registry.dataset(spark, folder).orders.count()
    assert registry.dataset(spark, folders[0]) is first
    assert profile.count() == rows
    registry.close_all(spark)
