"""Rows that have one of many ids, or none of them, without a shuffle of the others.

A join with ids that are too many to broadcast shuffles all rows. Here a bitmap of the ids' hashes goes to the rows first, 16 MB
at most for any number of ids. A row whose bit is not set has none of them; the rest, which are the rows that have one and a few more, are
settled by an exact join.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from order_analytics.operators.staging import Stage

ID = "MEMBER_ID"
#: Bits of the bitmap: with one id to 32 of them, three in a hundred of the other rows meet the ids as well.
BITS = 1 << 27


@dataclass(frozen=True)
class Members:
    """Distinct ids in the column ``MEMBER_ID``, and bitmaps of 32,768 bits each by their number."""

    ids: DataFrame
    bitmaps: DataFrame


def _place(value: Column) -> tuple[Column, Column]:
    bit = F.pmod(F.xxhash64(value), F.lit(BITS))
    return F.bitmap_bucket_number(bit), F.bitmap_bit_position(bit)


def keep(ids: DataFrame, stage: Stage) -> Members:
    """``ids`` has distinct ones in its only column. Bits travel to their bitmap, not partial bitmaps."""
    kept = stage.keep(ids.toDF(ID), "member-ids")
    number, bit = _place(F.col(ID))
    bits = kept.select(number.alias("BITMAP"), bit.alias("BIT")).repartition("BITMAP")
    bitmaps = bits.groupBy("BITMAP").agg(F.bitmap_construct_agg("BIT").alias("BITS"))
    return Members(kept, stage.keep(bitmaps, "member-bitmaps"))


def _by_bitmap(rows: DataFrame, members: Members, value: Column, how: str) -> DataFrame:
    """The rows whose bit is set (``left_semi``), or those whose bit is not (``left_anti``)."""
    number, bit = _place(value)
    byte = F.conv(F.hex(F.substring(F.col("BITS"), F.shiftright(bit, 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    is_set = F.getbit(byte, (bit % 8).cast("int")) == 1
    return rows.join(F.broadcast(members.bitmaps), (number == F.col("BITMAP")) & is_set, how)


def inside(rows: DataFrame, members: Members, value: Column) -> DataFrame:
    """The rows whose ``value`` is one of the ids."""
    return _by_bitmap(rows, members, value, "left_semi").join(members.ids, value == F.col(ID), "left_semi")


def split(rows: DataFrame, members: Members, value: Column, stage: Stage) -> tuple[DataFrame, DataFrame]:
    """The rows inside and those outside. What meets the ids is staged, so a reader of one part scans ``rows`` once at most."""
    met = _by_bitmap(rows, members, value, "left_semi").join(members.ids, value == F.col(ID), "left")
    near = stage.keep(met.select(*rows.columns, F.col(ID).isNotNull().alias("IS_MEMBER")), "near-members")
    inner, outer = (near.filter(chosen).select(rows.columns) for chosen in ("IS_MEMBER", "NOT IS_MEMBER"))
    return inner, _by_bitmap(rows, members, value, "left_anti").unionAll(outer)
