"""Reuse of intermediate results.

A staged result is written to the shared folder and read back, so it cuts the lineage and survives the
loss of executors.
"""

from __future__ import annotations

import gc
import time
import uuid

from pyspark.sql import DataFrame, SparkSession

from order_analytics import session


#: Of tables that are written once and read by several plans.
COMPRESSION = "zstd"

#: Rounds of collecting garbage, and seconds after each.
RELEASE_ROUNDS, RELEASE_PAUSE = 3, 0.4


def new_path(spark: SparkSession, label: str) -> str:
    """A folder under the staging folder that does not exist yet."""
    return f"{session.staging_folder(spark)}/staged/{label}-{uuid.uuid4().hex}"


def write_table(df: DataFrame, label: str, compression: str | None = None) -> tuple[DataFrame, str]:
    """Write ``df`` to a new folder under the staging folder; return it read back, and the path."""
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path), path


def drop_table(spark: SparkSession, path: str) -> None:
    """Remove a table that ``write_table`` wrote."""
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    location.getFileSystem(spark._jsc.hadoopConfiguration()).delete(location, True)


def forget_shuffles(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of plans whose results are written.

    It does so when the plans are collected as garbage, which a driver with memory to spare may put off. What has ended
    is let go of a moment later, by way of Spark's events, so it takes some rounds.
    """
    for _ in range(RELEASE_ROUNDS):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(RELEASE_PAUSE)


class Stage:
    """Keeps the staged results of one dataset, to be released together."""

    def __init__(self, spark: SparkSession):
        self._spark = spark
        self._paths: list[str] = []

    def keep(self, df: DataFrame, label: str) -> DataFrame:
        staged, path = write_table(df, label, COMPRESSION)
        self._paths.append(path)
        return staged

    def track(self, path: str) -> None:
        """Drop this staged table on release as well."""
        self._paths.append(path)

    def release(self) -> None:
        for path in self._paths:
            drop_table(self._spark, path)
        self._paths = []
