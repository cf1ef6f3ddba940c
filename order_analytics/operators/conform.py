"""Raw table -> typed table: column names, casts, exact duplicates."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from order_analytics.functions.columns import number_or_null, offset_timestamp, timestamp_or_null
from order_analytics.schemas import TableSpec

ORIGINAL = "__RAW_"


def upper_snake(name: str) -> str:
    """Words joined by underscores in upper case; one leading underscore survives."""
    words = "_".join(re.findall(r"[A-Za-z0-9]+", name)).upper()
    return f"_{words}" if name.startswith("_") else words


def normalize_columns(df: DataFrame) -> DataFrame:
    names = [upper_snake(name) for name in df.columns]
    clashes = sorted({name for name in names if names.count(name) > 1})
    if clashes:
        raise ValueError(f"Columns fall together after renaming: {clashes}")
    return df.toDF(*names)


def _typed(field: T.StructField, spec: TableSpec) -> Column:
    if field.name in spec.offset_timestamps:
        return offset_timestamp(field.name)
    if isinstance(field.dataType, T.StringType):
        return F.col(field.name).cast("string")
    return F.col(field.name).try_cast(field.dataType)


def cast_to_schema(df: DataFrame, spec: TableSpec, keep_originals: bool = False) -> DataFrame:
    """One projection to the typed schema; failed casts become NULL.

    ``keep_originals`` carries the watched columns along, for the cast-failure gate.
    """
    columns = [_typed(field, spec).alias(field.name) for field in spec.schema]
    if keep_originals:
        columns += [F.col(name).alias(ORIGINAL + name) for name in spec.watched_casts]
    return df.select(*columns)


def drop_originals(df: DataFrame) -> DataFrame:
    return df.drop(*[name for name in df.columns if name.startswith(ORIGINAL)])


#: Classes that rows are counted in by their digest, and rows from which on a class may hold very many copies of one.
CLASSES, MANY_COPIES = 1 << 16, 100_000


def drop_exact_duplicates(df: DataFrame, suspected: bool = True, placed: tuple[int, Sequence[str]] | None = None) -> DataFrame:
    """Copies collapse before the shuffle, so a large group of copies stays cheap.

    With ``placed``, a number of partitions and the columns to place rows by, all rows travel once, to the partitions that whoever works
    on those columns needs, and copies collapse there. Only rows of which there may be very many copies collapse ahead.

    Where no two rows share a digest there is no copy, and nothing ``suspected``: the rows stay where they are. Only minus zeros become
    plain ones, as they do where rows are compared.
    """
    if suspected and placed is None:
        return df.dropDuplicates()
    if suspected:
        number, columns = placed
        return _many_collapsed(df).repartition(number, *columns).dropDuplicates()
    floats = [field for field in df.schema if isinstance(field.dataType, T.FloatType | T.DoubleType)]
    return df.withColumns({f.name: F.when(F.col(f.name) == 0, F.lit(0).cast(f.dataType)).otherwise(F.col(f.name)) for f in floats})


def _many_collapsed(df: DataFrame) -> DataFrame:
    """The same rows, without copies of those that may have very many: one pass counts rows in classes of their digest.

    A class is full when it has ``MANY_COPIES`` rows and four times its share, so few are, whatever the number of rows.
    """
    number = F.pmod(F.xxhash64(*df.columns), F.lit(CLASSES)).cast("int")
    sizes = df.groupBy(number.alias("CLASS")).agg(F.count(F.lit(1)).alias("ROWS"))
    total = sizes.agg(F.sum("ROWS").alias("TOTAL"))
    fair = F.col("TOTAL") * 4 / CLASSES
    full = [row["CLASS"] for row in sizes.crossJoin(total).filter((F.col("ROWS") >= MANY_COPIES) & (F.col("ROWS") >= fair)).collect()]
    if not full:
        return df
    return df.filter(~number.isin(full)).unionAll(df.filter(number.isin(full)).dropDuplicates())


def coerce(df: DataFrame, numeric: list[str] = (), dates: list[str] = ()) -> DataFrame:
    """Numbers and dates where the text allows it, NULL elsewhere; absent columns are ignored."""
    changes = {name: number_or_null(name) for name in numeric if name in df.columns}
    changes |= {name: timestamp_or_null(name) for name in dates if name in df.columns}
    return df.withColumns(changes)
