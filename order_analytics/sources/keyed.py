"""Typed tables laid out by key, so that work on the key needs no further exchange.

A table is written in hash buckets of some key columns, each sorted by the whole key. Spark then knows how its scan is
partitioned and ordered: the key gate, the merge join with another table of the same layout and the join of lines with their options read it as
it lies. One exchange, at the write, replaces two for a join and one for each gate.

Rows that ``conform.drop_exact_duplicates`` has placed by the bucket columns already stay where they are: they travel once to be deduplicated and laid out. Rows with
very many copies have collapsed before, so that copies of one row do not meet in one bucket. Buckets are even when the columns are nearly unique; a key that
many rows share, which the gates refuse, would be one bucket's.

Joins on more columns than the buckets have rely on a setting that would let other joins keep uneven partitions, so it
holds in a session of its own, ``key_session``, in which such tables are read. The catalogue entry is only how Spark learns of the layout; it is
named after the folder, which any reader of Parquet can open as well.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from order_analytics import session
from order_analytics.operators import staging


@dataclass(frozen=True)
class Layout:
    """Buckets by ``columns``, sorted within by ``order``, which starts with them."""

    columns: tuple[str, ...]
    order: tuple[str, ...]
    buckets: int

    def __post_init__(self):
        if self.order[: len(self.columns)] != self.columns:
            raise ValueError("The order must start with the bucket columns.")


def key_session(spark: SparkSession) -> SparkSession:
    """A session of the same application, with the settings of ``spark``, in which partitions by part of a key serve work on the key."""
    own = spark.newSession()
    for name, value in {**session.SESSION_SETTINGS, **spark.conf.getAll}.items():
        if name.startswith("spark.sql.") and own.conf.isModifiable(name):
            own.conf.set(name, value)
    session.use_utc(own)
    own.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    own.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")
    return own


def table_name(path: str) -> str:
    return f"keyed_{hashlib.sha256(path.encode()).hexdigest()[:32]}"


def write(df: DataFrame, path: str, layout: Layout) -> DataFrame:
    """Write ``df`` to a new folder in this layout, one file a bucket, and read it back."""
    placed = df.repartition(layout.buckets, *layout.columns)
    writer = placed.write.format("parquet").option("path", path).option("compression", staging.COMPRESSION).bucketBy(layout.buckets, *layout.columns)
    writer.sortBy(*layout.order).saveAsTable(table_name(path))
    return df.sparkSession.table(table_name(path))


def read(spark: SparkSession, path: str, schema: str, layout: Layout) -> DataFrame:
    """A folder that ``write`` wrote, maybe in another application; ``schema`` as DDL."""
    names = {"columns": layout.columns, "order": layout.order}
    quoted = {part: ", ".join(f"`{name}`" for name in held) for part, held in names.items()}
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table_name(path)} ({schema}) USING parquet"
        f" CLUSTERED BY ({quoted['columns']}) SORTED BY ({quoted['order']}) INTO {layout.buckets} BUCKETS LOCATION '{path}'"
    )
    return spark.table(table_name(path))


def drop(spark: SparkSession, path: str) -> None:
    """Remove the catalogue entry and the folder."""
    spark.sql(f"DROP TABLE IF EXISTS {table_name(path)}")
    staging.drop_table(spark, path)


def write_all(tables: dict[str, tuple[DataFrame, Sequence[str]]], folder: str, columns: Sequence[str], buckets: int) -> dict[str, DataFrame]:
    """Several tables with their keys in buckets of the same columns, so that each joins with each as it lies. The shuffle files of one go before the next is written."""
    written = {}
    for name, (rows, key) in tables.items():
        layout = Layout(tuple(columns), (*columns, *[part for part in key if part not in columns]), buckets)
        written[name] = write(rows, f"{folder}/{name}", layout)
        staging.forget_shuffles(rows.sparkSession)
    return written
