"""Versioned snapshot tables on Parquet.

A version is a folder ``v=<n>``, written as a candidate and published by a marker file once its checks
have passed. The current version is the highest published one, so readers never see a version that is
half written or failed its checks, and no version is ever overwritten.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

PREFIX = "v="
PUBLISHED = "_PUBLISHED"

#: What a sync may do to a row.
ACTIONS = ("INSERT", "UPDATE", "DELETE", "UNCHANGED")


def _file_system(spark: SparkSession, path: str):
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()), location


def exists(spark: SparkSession, path: str) -> bool:
    files, location = _file_system(spark, path)
    return files.exists(location)


def _versions(spark: SparkSession, path: str, published_only: bool) -> list[int]:
    files, location = _file_system(spark, path)
    if not files.exists(location):
        return []
    folders = [entry.getPath() for entry in files.listStatus(location) if entry.getPath().getName().startswith(PREFIX)]
    marker = spark._jvm.org.apache.hadoop.fs.Path
    return [
        int(folder.getName().removeprefix(PREFIX))
        for folder in folders
        if not published_only or files.exists(marker(folder, PUBLISHED))
    ]


def published_versions(spark: SparkSession, path: str) -> list[int]:
    return sorted(_versions(spark, path, published_only=True))


def all_versions(spark: SparkSession, path: str) -> list[int]:
    """Candidates included."""
    return sorted(_versions(spark, path, published_only=False))


def child_folders(spark: SparkSession, path: str) -> list[str]:
    files, location = _file_system(spark, path)
    if not files.exists(location):
        return []
    return [entry.getPath().getName() for entry in files.listStatus(location) if entry.isDirectory()]


def current_version(spark: SparkSession, path: str) -> int | None:
    return max(_versions(spark, path, published_only=True), default=None)


def version_path(path: str, version: int) -> str:
    return f"{path.rstrip('/')}/{PREFIX}{version}"


def write_candidate(df: DataFrame, path: str) -> tuple[int, int]:
    """Write the next version, unpublished; return its number and the rows counted during the write."""
    version = next_version(df.sparkSession, path)
    written = Observation()
    df.observe(written, F.count(F.lit(1)).alias("ROWS")).write.parquet(version_path(path, version), compression="zstd")
    return version, written.get["ROWS"]


def publish(spark: SparkSession, path: str, version: int) -> None:
    files, marker = _file_system(spark, f"{version_path(path, version)}/{PUBLISHED}")
    files.create(marker, False).close()


def discard(spark: SparkSession, path: str, version: int) -> None:
    """Remove a candidate that is not needed."""
    files, location = _file_system(spark, version_path(path, version))
    files.delete(location, True)


def retire(spark: SparkSession, path: str, keep: int) -> list[int]:
    """Remove all but the ``keep`` newest published versions, and candidates older than the current one."""
    published = sorted(_versions(spark, path, published_only=True))
    if keep < 1 or not published:
        return []
    kept = set(published[-keep:])
    gone = [v for v in _versions(spark, path, published_only=False) if v not in kept and v < published[-1]]
    for version in gone:
        discard(spark, path, version)
    return gone


@contextmanager
def candidate(spark: SparkSession, path: str, version: int) -> Iterator[None]:
    """Discard the candidate when its checks, or anything else until it is published, raise."""
    try:
        yield
    except BaseException:
        discard(spark, path, version)
        raise


def next_version(spark: SparkSession, path: str) -> int:
    return max(_versions(spark, path, published_only=False), default=0) + 1


def read_version(spark: SparkSession, path: str, version: int, schema: StructType | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(version_path(path, version))


def read_current(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    version = current_version(spark, path)
    if version is None:
        raise FileNotFoundError(f"No snapshot at {path}")
    return read_version(spark, path, version, schema)


def add_lineage(df: DataFrame, ingested_at: datetime, source_table: str, load_type: str) -> DataFrame:
    return df.withColumns(
        {
            "_INGESTED_AT": F.lit(ingested_at).cast("timestamp"),
            "_SOURCE_TABLE": F.lit(source_table),
            "_LOAD_TYPE": F.lit(load_type),
        }
    )
