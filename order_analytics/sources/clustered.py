"""Marts clustered so that a filter on any of several columns reads few row groups.

Each column is cut into ``2 ** BITS`` ranges of about equally many rows; the bits of a row's ranges are interleaved (Z-order), rows are
sorted by that number over range partitions and written in small row groups. Rows that are near in all columns then stand together, and the
minima and maxima in the files rule out most row groups, which Spark's reader skips by itself. The cuts come from a bounded sample, which decides
the layout only: rows and results do not depend on it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of each column's range, and rows that the cuts are taken from.
BITS, SAMPLE = 5, 20_000
ROW_GROUP_BYTES = 8 * 1024 * 1024


def cuts(df: DataFrame, columns: Sequence[str]) -> dict[str, list]:
    """Values that cut a bounded sample of each column into about equal ranges."""
    sample = df.select(*columns).orderBy(F.xxhash64(*df.columns)).limit(SAMPLE).collect()
    found = {}
    for name in columns:
        values = sorted((row[name] for row in sample if row[name] is not None), key=lambda value: value.encode() if isinstance(value, str) else value)
        marks = [values[len(values) * place >> BITS] for place in range(1, 1 << BITS)] if values else []
        found[name] = list(dict.fromkeys(marks))
    return found


def z_number(marks: dict[str, list]) -> Column:
    """The interleaved bits of a row's ranges, the highest bit of the first column first."""
    ranges = {
        name: sum((F.when(F.col(name) >= F.lit(mark), 1).otherwise(0) for mark in values), F.lit(0)) for name, values in marks.items()
    }
    number, place = F.lit(0).cast("bigint"), len(marks) * BITS
    for bit in reversed(range(BITS)):
        for column in ranges.values():
            place -= 1
            number = number + F.shiftright(column, bit).bitwiseAND(F.lit(1)).cast("bigint") * F.lit(1 << place)
    return number


def write(df: DataFrame, columns: Sequence[str], path: str, files: int, row_group_bytes: int = ROW_GROUP_BYTES) -> None:
    """Write ``df`` clustered by ``columns`` into about so many files."""
    numbered = df.withColumn("__Z", z_number(cuts(df, columns)))
    placed = numbered.repartitionByRange(files, "__Z", *columns).sortWithinPartitions("__Z", *columns).drop("__Z")
    placed.write.option("parquet.block.size", row_group_bytes).parquet(path)
