"""Session settings and the shared folder that staged tables go to."""

from __future__ import annotations

import functools
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

SESSION_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

TARGET_PARTITION_BYTES = 128 * 1024 * 1024


def shuffle_partitions(input_bytes: int, cores: int) -> int:
    """Initial shuffle partitions so that each holds about 128 MB; AQE coalesces the rest."""
    return max(cores, -(-input_bytes // TARGET_PARTITION_BYTES))


def folder_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of all files under a folder of any file system."""
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(location).getLength()


def size_shuffles(spark: SparkSession, stored_bytes: int) -> int:
    """Raise the session's shuffle partitions to what input of this many Parquet bytes needs.

    Rows take about four times their size in Parquet. A larger number that the session has already stays.
    """
    needed = shuffle_partitions(4 * stored_bytes, spark.sparkContext.defaultParallelism)
    chosen = max(needed, int(spark.conf.get("spark.sql.shuffle.partitions")))
    spark.conf.set("spark.sql.shuffle.partitions", str(chosen))
    return chosen


def build_session(app_name: str = "order-analytics", master: str | None = None, **settings) -> SparkSession:
    """A UTC session with adaptive execution; keyword settings override (dots as ``__``)."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    overrides = {key.replace("__", "."): str(value) for key, value in settings.items()}
    for key, value in {**SESSION_SETTINGS, **overrides}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> None:
    """Dates are derived from UTC instants, so the session time zone must be UTC."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@contextmanager
def joined_as_placed(spark: SparkSession) -> Iterator[None]:
    """While it lasts, a join takes sides that are both placed by the same part of its key as they lie."""
    name = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        spark.conf.set(name, before)


@functools.cache
def _local_folder(application_id: str) -> str:
    return tempfile.mkdtemp(prefix="order-analytics-")


def staging_folder(spark: SparkSession) -> str:
    """The shared folder; a fresh local one only where no cluster is involved."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("Set spark.checkpoint.dir to a folder that all executors share.")
    return _local_folder(spark.sparkContext.applicationId)
