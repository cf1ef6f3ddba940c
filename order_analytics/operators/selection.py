"""Values at given places of a sorted column, without sorting it.

Each round counts the rows of ``RANGES`` equal value ranges around every wanted place and goes on inside the range that holds it, so only
counts move, and a column of whole numbers up to N takes log(N) / log(RANGES) rounds, whatever its distribution. Several
populations of one table are counted side by side. Equal values are told apart, where needed, by a unique text column in the same way, two bytes a round.

Numbers are integers or decimals. NULLs come first, as in Spark's ascending order.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from decimal import Decimal
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

RANGES = 1024
#: Rows with equal values that are few enough to be looked at one by one.
FEW = 1000


@dataclass(frozen=True)
class Wanted:
    """Places (from 1) of one population: rows that meet ``rows``, all if None. ``places`` gets the population's size."""

    places: Callable[[int], Sequence[int]]
    rows: Column | None = None


class Found(NamedTuple):
    """The value at a place, and the place among the rows of that value, from 1."""

    value: Decimal | int | None
    among_equals: int


class _Search:
    """One wanted place: the value lies between ``low`` and ``high`` in units; ``below`` rows have less than ``low``."""

    def __init__(self, population: str, place: int, low: int, high: int):
        self.population, self.place, self.low, self.high, self.below = population, place, low, high, 0

    def narrow(self, step: int, counts: Mapping[int, int]) -> None:
        for number in sorted(counts):
            if self.below + counts[number] >= self.place:
                self.low, self.high = self.low + number * step, min(self.high, self.low + (number + 1) * step - 1)
                return
            self.below += counts[number]
        raise RuntimeError("The rows changed while they were counted.")


def _scale(kind: T.DataType) -> int:
    if isinstance(kind, T.DecimalType):
        return kind.scale
    if isinstance(kind, T.IntegralType):
        return 0
    raise TypeError(f"Places are found in integers and decimals, not in {kind.simpleString()}")


def _number(value: int) -> Column:
    return F.lit(Decimal(value)).cast("decimal(38,0)")


def values_at(df: DataFrame, value: str, wanted: Mapping[str, Wanted]) -> tuple[dict[str, list[Found | None]], dict[str, int]]:
    """For each population what stands at its places, None beyond the last row; and the populations' sizes."""
    scale = _scale(df.schema[value].dataType)
    units = (F.col(value) * F.lit(Decimal(10**scale))).cast("decimal(38,0)").alias("UNITS")
    inside = {name: F.lit(True) if want.rows is None else F.coalesce(want.rows, F.lit(False)) for name, want in wanted.items()}
    rows = df.select(units, *[condition.alias(f"IN_{name}") for name, condition in inside.items()])
    totals = [F.count_if(F.col(f"IN_{name}")).alias(f"N_{name}") for name in wanted]
    nulls = [F.count_if(F.col(f"IN_{name}") & F.col("UNITS").isNull()).alias(f"NULLS_{name}") for name in wanted]
    ends = rows.agg(F.min("UNITS").alias("LOW"), F.max("UNITS").alias("HIGH"), *totals, *nulls).first()

    sizes = {name: ends[f"N_{name}"] for name in wanted}
    found: dict[str, list[Found | None]] = {}
    searches: dict[tuple[str, int], _Search] = {}
    places = {name: list(want.places(sizes[name])) for name, want in wanted.items()}
    for name, asked in places.items():
        for place in asked:
            if ends[f"NULLS_{name}"] < place <= sizes[name]:
                searches[name, place] = _Search(name, place - ends[f"NULLS_{name}"], int(ends["LOW"]), int(ends["HIGH"]))
    while open_searches := [search for search in searches.values() if search.low < search.high]:
        _round(rows, open_searches)

    for name, asked in places.items():
        found[name] = []
        for place in asked:
            if not 1 <= place <= sizes[name]:
                found[name].append(None)
            elif (name, place) in searches:
                search = searches[name, place]
                number = Decimal(search.low).scaleb(-scale) if scale else search.low
                found[name].append(Found(number, search.place - search.below))
            else:
                found[name].append(Found(None, place))
    return found, sizes


def _round(rows: DataFrame, searches: list[_Search]) -> None:
    """Count the ranges of all open searches in one pass; searches share a span or have spans apart."""
    spans = sorted({(search.low, search.high) for search in searches})
    steps = {span: -(-(span[1] - span[0] + 1) // RANGES) for span in spans}
    span, number = F.lit(None).cast("int"), F.lit(None).cast("bigint")  # of a row: which span, and which range of it
    for place, (low, high) in enumerate(spans):
        within = F.col("UNITS").between(_number(low), _number(high))
        span = F.when(within, place).otherwise(span)
        # whole division: a quotient of decimals would be rounded
        offset = F.expr(f"(UNITS - cast('{low}' AS decimal(38,0))) div cast('{steps[low, high]}' AS decimal(38,0))")
        number = F.when(within, offset).otherwise(number)
    names = sorted({search.population for search in searches})
    counts = [F.count_if(F.col(f"IN_{name}")).alias(name) for name in names]
    counted = rows.select(span.alias("SPAN"), number.alias("RANGE"), *[f"IN_{name}" for name in names]).filter("SPAN is not null")
    held = counted.groupBy("SPAN", "RANGE").agg(*counts).collect()
    for search in searches:
        place = spans.index((search.low, search.high))
        search.narrow(steps[spans[place]], {row["RANGE"]: row[search.population] for row in held if row["SPAN"] == place})


def text_at(texts: DataFrame, text: str, place: int) -> str:
    """The text at a place (from 1) of the sorted, non-null ``text`` column, by the bytes of UTF-8."""
    held = texts.select(F.col(text).cast("binary").alias("BYTES"))
    start = b""
    while True:
        here = held.filter(F.substring("BYTES", 1, len(start)) == F.lit(start)) if start else held
        counts = here.groupBy(F.substring("BYTES", len(start) + 1, 2).alias("NEXT")).count().collect()
        for row in sorted(counts, key=lambda row: bytes(row["NEXT"])):
            if place <= row["count"]:
                break
            place -= row["count"]
        else:
            raise IndexError("There are not so many rows.")
        start += bytes(row["NEXT"])
        if len(row["NEXT"]) < 2:
            return start.decode()
        if row["count"] <= FEW:
            last = held.filter(F.substring("BYTES", 1, len(start)) == F.lit(start)).collect()
            return sorted(bytes(one["BYTES"]) for one in last)[place - 1].decode()
