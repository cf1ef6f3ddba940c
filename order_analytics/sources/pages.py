"""Sorted tables that are read a page at a time.

A table is sorted once over range partitions and written with each row's place in its file. An index, one row for each file, has the
file's first key and the rows ahead of it. A page by number opens the files that its rows lie in, and a page after a key the file where
that key would stand and those after it until the page is full; both are one file, or two where a page crosses files. The index is small
(a row for a file), so it goes through the driver.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Sequence
from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from order_analytics.operators import staging

PLACE = "__PLACE"
#: monotonically_increasing_id keeps the partition above this bit and the row's place in it below.
PLACE_BITS = 33


@dataclass(frozen=True)
class Key:
    """A column of the order."""

    name: str
    descending: bool = False

    def order(self) -> Column:
        return F.desc(self.name) if self.descending else F.asc(self.name)


@dataclass(frozen=True)
class SortedTable:
    """What ``write`` wrote: files in order, the rows ahead of each, and the key of each one's first row."""

    spark: SparkSession
    path: str
    schema: StructType
    keys: tuple[Key, ...]
    files: tuple[int, ...]
    ahead: tuple[int, ...]
    first: tuple[tuple, ...]
    rows: int

    def _scan(self, places: Sequence[int]) -> DataFrame:
        """These files, and no others: a file is a folder named by its number."""
        paths = [f"{self.path}/rows/FILE={self.files[place]}" for place in places]
        stored = StructType([*self.schema.fields, StructField(PLACE, LongType())])
        return self.spark.read.schema(stored).parquet(*paths) if paths else self.spark.createDataFrame([], stored)

    def _sorted(self, rows: DataFrame, size: int) -> DataFrame:
        return rows.orderBy(*[key.order() for key in self.keys]).limit(size).select(self.schema.names)

    def page(self, number: int, size: int) -> DataFrame:
        """Page ``number``, from 0; pages beyond the last are empty."""
        start, end = number * size, min((number + 1) * size, self.rows)
        if start >= end:
            return self._sorted(self._scan([]), size)
        low, high = bisect_right(self.ahead, start) - 1, bisect_right(self.ahead, end - 1) - 1
        stamp = [(self.files[place] << PLACE_BITS) + row - self.ahead[place] for place, row in ((low, start), (high, end - 1))]
        return self._sorted(self._scan(range(low, high + 1)).filter(F.col(PLACE).between(*stamp)), size)

    def after(self, values: Sequence, size: int) -> DataFrame:
        """The rows that follow a key in the order, as many as a page has. The values need not be those of a row."""
        place = max(0, bisect_right(self.first, _Sorted(values, self.keys), key=lambda first: _Sorted(first, self.keys)) - 1)
        rows = self._scan([]).limit(0)
        read: list[int] = []
        while place < len(self.files):
            read.append(place)
            rows = self._scan(read).filter(self._follows(values))
            # files after the first are read whole, so their counts say when the page is full
            if len(read) > 1 and sum(self._size(other) for other in read[1:]) >= size:
                break
            if len(read) == 1 and rows.limit(size).count() == size:
                break
            place += 1
        return self._sorted(rows, size)

    def _size(self, place: int) -> int:
        return (self.ahead[place + 1] if place + 1 < len(self.ahead) else self.rows) - self.ahead[place]

    def _follows(self, values: Sequence) -> Column:
        """Rows whose key sorts after the values; NULL is first where the order ascends, last where it descends."""
        later, same = F.lit(False), F.lit(True)
        for key, value in zip(self.keys, values, strict=True):
            column, literal = F.col(key.name), F.lit(value)
            if key.descending:
                beyond = F.lit(False) if value is None else column.isNull() | (column < literal)
            else:
                beyond = column.isNotNull() if value is None else column > literal
            later = later | (same & F.coalesce(beyond, F.lit(False)))
            same = same & column.eqNullSafe(literal)
        return later

    def drop(self) -> None:
        staging.drop_table(self.spark, self.path)


class _Sorted:
    """A key that compares as the order does."""

    def __init__(self, values: Sequence, keys: Sequence[Key]):
        self.values, self.keys = values, keys

    def __lt__(self, other: _Sorted) -> bool:
        for one, two, key in zip(self.values, other.values, self.keys, strict=True):
            if one == two:
                continue
            if one is None or two is None:
                return (one is None) != key.descending
            if isinstance(one, str):
                one, two = one.encode(), two.encode()
            return (one > two) if key.descending else (one < two)
        return False


def write(df: DataFrame, keys: Sequence[Key], path: str, files: int) -> SortedTable:
    """Sort ``df`` by ``keys``, which must tell its rows apart, and write it in about ``files`` files, with its index."""
    spark, order = df.sparkSession, [key.order() for key in keys]
    part = F.shiftright(PLACE, PLACE_BITS).alias("FILE")
    placed = df.repartitionByRange(files, *order).sortWithinPartitions(*order).withColumn(PLACE, F.monotonically_increasing_id())
    placed.withColumn("FILE", part).write.partitionBy("FILE").parquet(f"{path}/rows")
    stored = StructType([*df.schema.fields, StructField(PLACE, LongType()), StructField("FILE", IntegerType())])
    written = spark.read.schema(stored).parquet(f"{path}/rows")
    first = F.min_by(F.struct(*[key.name for key in keys]), PLACE).alias("FIRST")
    written.groupBy("FILE").agg(F.count(F.lit(1)).alias("ROWS"), first).coalesce(1).write.parquet(f"{path}/index")
    return read(spark, path, df.schema, keys)


def read(spark: SparkSession, path: str, schema: StructType, keys: Sequence[Key]) -> SortedTable:
    """A table that ``write`` wrote."""
    index: list[Row] = spark.read.parquet(f"{path}/index").orderBy("FILE").collect()
    ahead = list(accumulate((row["ROWS"] for row in index), initial=0))
    files = tuple(row["FILE"] for row in index)
    first = tuple(tuple(row["FIRST"]) for row in index)
    return SortedTable(spark, path, schema, tuple(keys), files, tuple(ahead[:-1]), first, ahead[-1])
