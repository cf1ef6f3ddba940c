"""Mart tables as Parquet folders.

All marts of a run are written under one version and become current together, once the version is published.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from order_analytics.sources import snapshots

# The mart names.
MARTS = (
    "customer_clv",
    "customer_rfm",
    "churn_indicators",
    "sales_trends_daily",
    "sales_trends_weekly",
    "sales_trends_monthly",
    "loyalty_program_impact",
    "restaurant_performance",
    "discount_effectiveness",
)


def add_mart_metadata(df: DataFrame, analysis_date: date, generated_at: datetime) -> DataFrame:
    return df.withColumns(
        {
            "_GENERATED_AT": F.lit(generated_at).cast("timestamp"),
            "_ANALYSIS_DATE": F.lit(analysis_date).cast("date"),
        }
    )


def write_mart(df: DataFrame, root: str, version: int, name: str, analysis_date: date, generated_at: datetime) -> int:
    """Write one mart of a version; the row count comes from the same pass."""
    written = Observation()
    stamped = add_mart_metadata(df, analysis_date, generated_at)
    target = f"{snapshots.version_path(root, version)}/{name}"
    stamped.observe(written, F.count(F.lit(1)).alias("ROWS")).write.parquet(target)
    return written.get["ROWS"]


def read_mart(spark: SparkSession, root: str, name: str, version: int | None = None) -> DataFrame:
    """A mart of the current version, or of the one given."""
    if name not in MARTS:
        raise ValueError(f"Unknown mart: {name}")
    version = version if version is not None else snapshots.current_version(spark, root)
    if version is None or not snapshots.exists(spark, f"{snapshots.version_path(root, version)}/{name}"):
        raise FileNotFoundError(f"No mart {name} at {root}")
    return spark.read.parquet(f"{snapshots.version_path(root, version)}/{name}")
