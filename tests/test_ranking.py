"""The global ranks equal the unpartitioned window functions on random data."""

from __future__ import annotations

from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from order_analytics.operators import ranking
from order_analytics.operators.staging import Stage

SCHEMA = "ID string, V decimal(30,2)"
cents = st.one_of(st.integers(-3, 3), st.integers(-(10**12), 10**12))
relaxed = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


def rows_of(values):
    return [(f"u{place}", None if value is None else Decimal(value) / 100) for place, value in enumerate(values)]


def test_tile_openings_equal_ntile():
    for total in range(60):
        openings = ranking.tile_openings(total, 5)
        size, larger = divmod(total, 5)
        tiles = [tile for tile in range(5) for _ in range(size + (tile < larger))]
        ours = [sum(rank >= opening for opening in openings) for rank in range(1, total + 1)]
        assert ours == tiles


def test_score_openings_equal_ceil_of_cume_dist():
    for total in range(1, 80):
        openings = ranking.score_openings(total, 4)
        for upto in range(1, total + 1):
            assert 1 + sum(upto >= opening for opening in openings) == -(-4 * upto // total)


@relaxed
@given(st.lists(st.one_of(st.none(), cents), min_size=0, max_size=60))
def test_ntile(spark, values):
    df = spark.createDataFrame(rows_of(values), SCHEMA)
    stock = F.ntile(5).over(Window.orderBy(F.asc("V"), F.asc("ID")))
    both = df.select(ranking.ntile(df, "V", "ID", 5).alias("OURS"), "ID").join(
        df.select(stock.alias("STOCK"), "ID"), "ID"
    )
    assert both.filter("OURS <> STOCK").count() == 0
    assert both.count() == len(values)


@relaxed
@given(st.lists(cents, min_size=1, max_size=60))
def test_cume_bands(spark, values):
    df = spark.createDataFrame(rows_of(values), SCHEMA).withColumn("W", F.floor(F.col("V") / 100))
    up, down = Window.orderBy(F.asc("V")), Window.orderBy(F.desc("W"))
    checked = df.select(
        "ID",
        ranking.cume_band(df, "V", 4).alias("A"),
        ranking.cume_band_of_counts(df, "W", 5, descending=True).alias("B"),
        F.ceil(F.cume_dist().over(up) * 4).alias("STOCK_A"),
        F.ceil(F.cume_dist().over(down) * 5).alias("STOCK_B"),
    )
    assert checked.filter("A <> STOCK_A OR B <> STOCK_B").count() == 0


@relaxed
@given(st.lists(st.one_of(st.none(), cents), min_size=1, max_size=60))
def test_dense_rank(spark, values):
    df = spark.createDataFrame(rows_of(values), SCHEMA)
    stage = Stage(spark)
    ranked = ranking.dense_rank(df, "V", "RANK", descending=True, stage=stage)
    checked = ranked.withColumn("STOCK", F.dense_rank().over(Window.orderBy(F.desc("V"))))
    assert checked.filter("RANK <> STOCK").count() == 0
    assert ranked.count() == len(values)
    stage.release()


@pytest.mark.parametrize("rank", [1, 2, 777, 999, 1000])
def test_rows_at_over_many_partitions(spark, rank):
    df = spark.range(1000).select(F.format_string("k%04d", F.col("id")).alias("ID"), F.lit(1).alias("V"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows, total = ranking.rows_at(df, [F.asc("V"), F.asc("ID")], lambda n: [rank, n + 1])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert total == 1000
    assert rows[0]["ID"] == f"k{rank - 1:04d}"
    assert rows[1] is None
