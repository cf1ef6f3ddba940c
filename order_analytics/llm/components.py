"""Connected components of a table of links, by rounds of star contraction.

Each round hangs the larger neighbours of every node onto the smallest node it knows (large stars), then
does so for the smaller ones (small stars). Links stay a table: no more rows than before, none collected. Rounds
are cut by written tables, so a lost executor repeats one round at most. Both sides of the joins are
hash-partitioned on the node, so adaptive execution splits a node with very many links.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from order_analytics.operators import staging


def _smallest_of(stars: DataFrame) -> DataFrame:
    return stars.groupBy("node").agg(F.min("other").alias("least"))


def _large_stars(links: DataFrame) -> DataFrame:
    stars = links.select("node", "other").union(links.select(F.col("other").alias("node"), F.col("node").alias("other")))
    least = _smallest_of(stars).select("node", F.least("node", "least").alias("least"))
    return stars.join(least, "node").filter("other > node").select(F.col("other").alias("node"), F.col("least").alias("other"))


def _small_stars(links: DataFrame) -> DataFrame:
    least = _smallest_of(links)
    hung = links.join(least, "node").filter("other <> least").select(F.col("other").alias("node"), F.col("least").alias("other"))
    return hung.union(least.select("node", F.col("least").alias("other"))).distinct()


def connected_components(links: DataFrame) -> DataFrame:
    """(node, root) for the nodes of ``links(node, other)``; the root is the smallest node of the component.

    Links may repeat and go either way; a link from a node to itself or with a null is none. Roots
    themselves are not listed, nor are nodes without links.
    """
    spark = links.sparkSession
    high, low = F.greatest("node", "other").alias("node"), F.least("node", "other").alias("other")
    links = links.dropna().select(high, low).filter("node > other").distinct()
    current, path = staging.write_table(links, "links")
    seen = _state(current)
    while True:
        following, following_path = staging.write_table(_small_stars(_large_stars(current)), "links")
        staging.drop_table(spark, path)
        current, path = following, following_path
        state = _state(current)
        if state == seen:
            return current.select("node", F.col("other").alias("root"))
        seen = state


def _state(links: DataFrame) -> tuple:
    """Count and order-free hash sum: equal for equal sets of links."""
    total = F.sum(F.xxhash64("node", "other").cast("decimal(20,0)"))
    return tuple(links.agg(F.count("*"), total).first())
