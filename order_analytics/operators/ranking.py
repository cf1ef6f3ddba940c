"""Ranks over a whole table without moving it into one partition.

A window without PARTITION BY sends every row to one task. Tiles and scores take only a handful of distinct values, so a few cut
rows decide them: the rows that open each tile. Those are found by counts (``selection``) and applied to all rows as literals, with
no sort and no join.

A rank that is a number for every row needs an order: rows, or their distinct values, are sorted globally (range partitions), each is
stamped with its partition and offset, and the stamped rows are written to a staged table, which fixes the positions. Row
counts per partition then turn a stamp into a position. The sort order ends in a unique column, so equal values spread over
partitions as well.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from order_analytics.operators.selection import Found, Wanted, text_at, values_at
from order_analytics.operators.staging import COMPRESSION, Stage, drop_table, write_table

STAMP = "__STAMP"
# monotonically_increasing_id keeps the partition above bit 33 and the offset below.
OFFSET_BITS = 33


def _stamped(df: DataFrame, order: list[Column], label: str) -> tuple[DataFrame, str, dict[int, int], int]:
    """Sorted and stamped rows, their path, the rows ahead of each partition, and the row total."""
    stamped, path = write_table(
        df.sort(*order).withColumn(STAMP, F.monotonically_increasing_id()), label, COMPRESSION
    )
    sizes = stamped.groupBy(F.shiftright(STAMP, OFFSET_BITS).alias("PART")).count().orderBy("PART").collect()
    ahead = accumulate((row["count"] for row in sizes), initial=0)
    starts = dict(zip((row["PART"] for row in sizes), ahead))
    return stamped, path, starts, sum(row["count"] for row in sizes)


def rows_at(df: DataFrame, order: list[Column], ranks: Callable[[int], list[int]]) -> tuple[list[Row | None], int]:
    """The rows at the given 1-based positions, and the row count.

    ``ranks`` maps the row count to the wanted positions, a short list. ``order`` must be total.
    A position beyond the last row gives None.
    """
    stamped, path, starts, total = _stamped(df, order, "ranks")
    wanted = ranks(total)
    stamps = [_stamp_of(rank, starts) if 1 <= rank <= total else None for rank in wanted]
    looked_up = [stamp for stamp in stamps if stamp is not None]
    found = {row[STAMP]: row for row in stamped.filter(F.col(STAMP).isin(looked_up)).collect()}
    drop_table(df.sparkSession, path)
    return [found.get(stamp) for stamp in stamps], total


def _stamp_of(rank: int, starts: dict[int, int]) -> int:
    part = max((part for part, ahead in starts.items() if ahead < rank), key=starts.get)
    return (part << OFFSET_BITS) + (rank - 1 - starts[part])


def tile_openings(total: int, tiles: int) -> list[int]:
    """First position of tiles 2..n: the first ``total % n`` tiles hold one row more."""
    size, larger = divmod(total, tiles)
    return [tile * size + min(tile, larger) + 1 for tile in range(1, tiles)]


def _at_or_after(df: DataFrame, value: str, tie: str, opening: Found) -> Column:
    """(value, tie) sorts at or after the opening row; NULL sorts first."""
    same = F.col(value).eqNullSafe(F.lit(opening.value))
    later = F.col(value).isNotNull() if opening.value is None else F.coalesce(F.col(value) > F.lit(opening.value), F.lit(False))
    if opening.among_equals == 1:
        return later | same
    text = text_at(df.filter(same).select(tie), tie, opening.among_equals)
    return later | (same & (F.col(tie) >= F.lit(text)))


def ntile(df: DataFrame, value: str, tie: str, tiles: int, openings: list[Found | None] | None = None) -> Column:
    """``ntile(tiles) OVER (ORDER BY value, tie)`` as an expression on ``df``; ``tie`` is unique text.

    ``openings`` has what stands at ``tile_openings``, where that is known already.
    """
    if openings is None:
        found, _ = values_at(df, value, {"all": Wanted(lambda total: tile_openings(total, tiles))})
        openings = found["all"]
    steps = [F.when(_at_or_after(df, value, tie, opening), 1).otherwise(0) for opening in openings if opening is not None]
    return sum(steps, F.lit(1)).cast("int")


def score_openings(total: int, bands: int) -> list[int]:
    """``ceil(bands * cume_dist)`` exceeds k for every value from position ``k * total // bands + 1`` on."""
    return [band * total // bands + 1 for band in range(1, bands)]


def _band(value: str, cuts: list, descending: bool) -> Column:
    column = F.col(value)
    steps = [
        F.when(column <= F.lit(cut) if descending else column >= F.lit(cut), 1).otherwise(0)
        for cut in cuts
        if cut is not None
    ]
    return sum(steps, F.lit(1)).cast("int")


def cume_band(df: DataFrame, value: str, bands: int) -> Column:
    """``ceil(bands * cume_dist() OVER (ORDER BY value))`` for a column with many distinct values."""
    found, _ = values_at(df, value, {"all": Wanted(lambda total: score_openings(total, bands))})
    return _band(value, [opening and opening.value for opening in found["all"]], descending=False)


def cume_band_of_counts(df: DataFrame, value: str, bands: int, descending: bool = False) -> Column:
    """The same for a column with few distinct values.

    Counts per value come first, so only one row per distinct value reaches the window. Use it where
    that number has a bound: days since a date, or order counts (k distinct positive counts need at
    least k*(k+1)/2 orders).
    """
    counts = df.groupBy(value).agg(F.count(F.lit(1)).alias("N"))
    running = counts.select(
        value,
        F.expr(f"sum(N) OVER (ORDER BY {value} {'DESC' if descending else 'ASC'})").alias("UP_TO"),
        F.expr("sum(N) OVER ()").alias("TOTAL"),
    )
    pick = F.max if descending else F.min
    cuts = running.agg(
        *[
            pick(F.when(F.col("UP_TO") > F.expr(f"{band} * TOTAL div {bands}"), F.col(value))).alias(f"CUT_{band}")
            for band in range(1, bands)
        ]
    ).first()
    return _band(value, list(cuts), descending)


def dense_rank(
    df: DataFrame, value: str, position: str, descending: bool = False, stage: Stage | None = None
) -> DataFrame:
    """``dense_rank() OVER (ORDER BY value)`` as the column ``position``.

    Only the distinct values are sorted. The rows ahead of each partition are one number per shuffle
    partition, which bounds the broadcast. The staged values live as long as ``stage``.
    """
    order = [F.desc(value) if descending else F.asc(value)]
    stamped, path, starts, _ = _stamped(df.select(value).distinct(), order, "dense-rank")
    if stage is not None:
        stage.track(path)
    offsets = df.sparkSession.createDataFrame(
        [(part, ahead) for part, ahead in starts.items()], "PART long, AHEAD long"
    )
    offset_mask = (1 << OFFSET_BITS) - 1
    ranks = (
        stamped.withColumn("PART", F.shiftright(STAMP, OFFSET_BITS))
        .join(F.broadcast(offsets), "PART")
        .select(
            F.col(value).alias("__RANKED"),
            (F.col("AHEAD") + F.col(STAMP).bitwiseAND(F.lit(offset_mask)) + 1).cast("int").alias(position),
        )
    )
    return df.join(ranks, F.col(value).eqNullSafe(F.col("__RANKED")), "inner").drop("__RANKED")


def numbered(df: DataFrame, order: list[str], position: str, stage: Stage) -> DataFrame:
    """The rows with their place from 1 in a total order, as the column ``position``. Sorted and written once; no window."""
    stamped, path, starts, _ = _stamped(df, [F.asc(name) for name in order], "numbered")
    stage.track(path)
    offsets = df.sparkSession.createDataFrame([(part, ahead) for part, ahead in starts.items()], "PART long, AHEAD long")
    offset = F.col(STAMP).bitwiseAND(F.lit((1 << OFFSET_BITS) - 1))
    placed = stamped.withColumn("PART", F.shiftright(STAMP, OFFSET_BITS)).join(F.broadcast(offsets), "PART")
    return placed.withColumn(position, F.col("AHEAD") + offset + 1).select(*df.columns, position)
