"""Relational source.

A scan is split over connections by a numeric or date column, which Spark does by itself, or by a text key: then each part is a range of
keys between cuts that the source takes from its own sorted keys, so that both sides compare alike. Parts cover the table and are
disjoint whatever the cuts are, as long as they ascend; rows without a key are in the first.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from order_analytics.sources import snapshots

# Fixed value: seconds after which a source query is given up.
QUERY_TIMEOUT = 600


@dataclass(frozen=True)
class Split:
    """How the scan of one table is spread over connections: a numeric or date column, and how many."""

    column: str
    connections: int


@dataclass(frozen=True)
class KeySplit:
    """The same by a text key: so many ranges of keys, ``connections`` of them at a time. ``sample`` is the source's clause
    for reading part of the table to find the cuts, e.g. ``TABLESAMPLE (1 PERCENT)``; without one it sorts all keys."""

    column: str
    parts: int
    connections: int
    sample: str = ""


def cuts_query(table: str, split: KeySplit) -> str:
    """The first key of each of equally many distinct keys, but for the smallest."""
    keys = f"SELECT DISTINCT {split.column} AS K FROM {table} {split.sample} WHERE {split.column} IS NOT NULL"
    tiles = f"SELECT K, NTILE({split.parts}) OVER (ORDER BY K) AS TILE FROM ({keys}) distinct_keys"
    return f"(SELECT TILE, MIN(K) AS CUT FROM ({tiles}) tiles WHERE TILE > 1 GROUP BY TILE) cuts"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def key_ranges(column: str, cuts: Sequence[str]) -> list[str]:
    """A predicate for each range between the ascending cuts: all rows are in exactly one, those without a key in the first."""
    if not cuts:
        return ["1 = 1"]
    inner = [f"{column} >= {_quoted(low)} AND {column} < {_quoted(high)}" for low, high in zip(cuts, cuts[1:])]
    return [f"{column} < {_quoted(cuts[0])} OR {column} IS NULL", *inner, f"{column} >= {_quoted(cuts[-1])}"]


def read_by_key(spark: SparkSession, url: str, table: str, predicates: Sequence[str], **options) -> DataFrame:
    """The rows of some ranges, each over a connection of its own."""
    properties = {name: str(value) for name, value in {"queryTimeout": QUERY_TIMEOUT, **options}.items()}
    return spark.read.jdbc(url, table, predicates=list(predicates), properties=properties)


def fetch_cuts(spark: SparkSession, url: str, table: str, split: KeySplit, **options) -> list[str]:
    """The cuts, one for a part, in the source's order."""
    reader = spark.read.format("jdbc").options(url=url, **{"queryTimeout": QUERY_TIMEOUT, **options})
    found = reader.option("dbtable", cuts_query(table, split)).load().collect()
    return [row["CUT"] for row in sorted(found, key=lambda row: row["TILE"])]


def land_by_key(
    spark: SparkSession, folder: str, predicates: Sequence[str], connections: int, read: Callable[[Sequence[str]], DataFrame]
) -> DataFrame:
    """Land a table lot by lot and return what was landed. A lot is the ranges that are read at a time.

    Each lot is a version of its own in ``folder``, published once it is written: after a failure, only lots that are not are read
    again. The predicates must be the same as in the run before, so keep the cuts with the folder.
    """
    lots = [predicates[first : first + connections] for first in range(0, len(predicates), connections)]
    paths = [f"{folder}/lot-{number}" for number in range(len(lots))]
    for lot, path in zip(lots, paths, strict=True):
        if snapshots.current_version(spark, path) is None:
            version, _ = snapshots.write_candidate(read(lot), path)
            snapshots.publish(spark, path, version)
    return spark.read.parquet(*[snapshots.version_path(path, snapshots.current_version(spark, path)) for path in paths])


def bounds_query(table: str, column: str) -> str:
    return f"(SELECT MIN({column}) AS LOWEST, MAX({column}) AS HIGHEST FROM {table}) bounds"


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    partition_column: str | None = None,
    num_partitions: int | None = None,
    lower_bound=None,
    upper_bound=None,
    **options,
) -> DataFrame:
    """Scan a whole table, over several connections when a numeric or date column to split on is named.

    Without one, the whole table comes over one connection and through one task: that is for small tables. Missing bounds are asked from the source (one row). Credentials and the driver come in ``options``.
    """
    reader = spark.read.format("jdbc").options(url=url, **{"queryTimeout": QUERY_TIMEOUT, **options})
    if partition_column and num_partitions:
        if lower_bound is None or upper_bound is None:
            found = reader.option("dbtable", bounds_query(table, partition_column)).load().first()
            lower_bound, upper_bound = found[0], found[1]
        if lower_bound is not None:
            reader = reader.options(
                partitionColumn=partition_column,
                lowerBound=str(lower_bound),
                upperBound=str(upper_bound),
                numPartitions=num_partitions,
            )
    return reader.option("dbtable", table).load()


def read_tables(spark: SparkSession, url: str, splits: Mapping[str, Split | KeySplit | None], **options) -> dict[str, DataFrame]:
    """Scans of the tables that ``splits`` names; None reads a small table over one connection."""
    scans = {}
    for table, split in splits.items():
        if isinstance(split, KeySplit):
            ranges = key_ranges(split.column, fetch_cuts(spark, url, table, split, **options))
            scans[table] = read_by_key(spark, url, table, ranges, **options)
        else:
            scans[table] = read_jdbc(spark, url, table, split and split.column, split and split.connections, **options)
    return scans
