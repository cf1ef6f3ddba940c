"""Counts and extremes of stored tables from their Parquet footers alone.

Spark's second Parquet reader answers count, min and max without reading a column, where nothing is filtered. It is off by default, so
it is switched on in a session of its own, for these questions only. Text and timestamps have no reliable extremes in footers; dates and
numbers have.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def footer_session(spark: SparkSession) -> SparkSession:
    own = spark.newSession()
    first_reader = own.conf.get("spark.sql.sources.useV1SourceList").split(",")
    own.conf.set("spark.sql.sources.useV1SourceList", ",".join(name for name in first_reader if name != "parquet"))
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    own.conf.set("spark.sql.session.timeZone", "UTC")
    return own


def summary(spark: SparkSession, path: str, columns: Sequence[str] = ()) -> DataFrame:
    """One row: ``ROWS``, and ``MIN_`` and ``MAX_`` of the named columns."""
    stored = footer_session(spark).read.parquet(path)
    ends = [end(name).alias(f"{label}_{name}") for name in columns for label, end in (("MIN", F.min), ("MAX", F.max))]
    return stored.agg(F.count(F.lit(1)).alias("ROWS"), *ends)


def row_count(spark: SparkSession, path: str) -> int:
    return summary(spark, path).first()["ROWS"]
