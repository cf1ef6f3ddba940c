"""Snapshots kept in key buckets: a sync reads and rewrites only the buckets that changed.

A row's bucket is a function of its key, so rows that a merge must match share one: a hash of the key, which keeps buckets even, within
the month of a key's timestamp if the table names one, which keeps together what changes together.
Each version is a folder ``v=<n>`` with the buckets it wrote (``rows/BUCKET=<b>``), what it changed (``changes``) and a manifest: for
every bucket of the table the version that holds it, its row count and an order-free digest of its rows. An unchanged bucket is an entry that
points at an older folder. Versions are candidates until a marker publishes them, as in ``snapshots``.

The manifest has one entry for each bucket, so it goes through the driver: choose as many buckets as make one bucket a task's worth
(about 0.5 GB), some thousands for a table of terabytes.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from decimal import Decimal
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from order_analytics.operators import quality, staging
from order_analytics.operators import sync as sync_rows
from order_analytics.schemas import TableSpec
from order_analytics.sources import snapshots

BUCKET = "BUCKET"
#: Folders that a table may be spread over; a sync rewrites the oldest beyond them.
MOST_VERSIONS = 16
MANIFEST = "BUCKET int, VERSION int, ROWS bigint, DIGEST_A decimal(38,0), DIGEST_B decimal(38,0)"


class Entry(NamedTuple):
    """One bucket of the manifest."""

    version: int
    rows: int
    digest: tuple[Decimal, Decimal]


@dataclass(frozen=True)
class BucketedTable:
    """A typed table in ``buckets`` buckets, each month of ``period`` apart if that names a date or timestamp of the key.

    ``compare`` names the columns whose change makes a row an update.
    """

    spec: TableSpec
    buckets: int
    compare: tuple[str, ...]
    period: str | None = None

    @classmethod
    def of(cls, spec: TableSpec, buckets: int, period: str | None = None) -> BucketedTable:
        if period is not None and period not in spec.key:
            raise ValueError(f"{period} is no part of the key of {spec.name}")
        return cls(spec, buckets, tuple(spec.business_columns), period)

    def number(self) -> Column:
        """The bucket of a row: from the first 28 bits of a digest of its key, and the month counted from year 0."""
        key = F.concat_ws("|", *[F.col(name).cast("string") for name in self.spec.key])
        hashed = F.conv(F.left(F.md5(key), F.lit(7)), 16, 10).cast("int") % self.buckets
        if self.period is None:
            return hashed.cast("int")
        month = F.coalesce(F.year(self.period) * 12 + F.month(self.period), F.lit(0))
        return (month * self.buckets + hashed).cast("int")


def _digests(rows: DataFrame, table: BucketedTable) -> dict[int, Entry]:
    """Row count and digest of each bucket that has rows."""
    sums = [F.sum(digest.cast("decimal(38,0)")) for digest in sync_rows.row_digests(table.compare)]
    found = rows.groupBy(table.number().alias(BUCKET)).agg(F.count(F.lit(1)).alias("ROWS"), *sums)
    return {number: Entry(0, count, tuple(digest)) for number, count, *digest in found.collect()}


def _folder(path: str, version: int, part: str) -> str:
    return f"{snapshots.version_path(path, version)}/{part}"


def manifest(spark: SparkSession, path: str, version: int) -> dict[int, Entry]:
    rows = spark.read.schema(MANIFEST).parquet(_folder(path, version, "manifest")).collect()
    return {row[BUCKET]: Entry(row["VERSION"], row["ROWS"], (row["DIGEST_A"], row["DIGEST_B"])) for row in rows}


def _read(spark: SparkSession, path: str, entries: dict[int, Entry], schema: StructType) -> DataFrame:
    """The rows of these buckets, one scan for each folder that holds some; others are not opened."""
    by_version = defaultdict(list)
    for number, entry in entries.items():
        if entry.rows:
            by_version[entry.version].append(number)
    stored = StructType([*schema.fields, StructField(BUCKET, IntegerType())])
    parts = [
        spark.read.schema(stored).parquet(_folder(path, version, "rows")).filter(F.col(BUCKET).isin(numbers))
        for version, numbers in sorted(by_version.items())
    ]
    return reduce(DataFrame.unionAll, parts) if parts else spark.createDataFrame([], stored)


def read_version(spark: SparkSession, path: str, version: int, schema: StructType) -> DataFrame:
    return _read(spark, path, manifest(spark, path, version), schema).drop(BUCKET)


def read_current(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    version = snapshots.current_version(spark, path)
    if version is None:
        raise FileNotFoundError(f"No snapshot at {path}")
    return read_version(spark, path, version, schema)


def read_changes(spark: SparkSession, path: str, version: int, schema: StructType) -> DataFrame:
    """What a version changed: ``ACTION``, and the row before (``OLD``) and after (``NEW``), NULL where there is none."""
    fields = [StructField("ACTION", StringType()), StructField("OLD", schema), StructField("NEW", schema)]
    return spark.read.schema(StructType(fields)).parquet(_folder(path, version, "changes"))


def _too_old(held: dict[int, Entry]) -> set[int]:
    """Buckets of the oldest folders beyond ``MOST_VERSIONS``, to be rewritten along the way."""
    versions = sorted({entry.version for entry in held.values() if entry.rows})
    gone = set(versions[: max(0, len(versions) - MOST_VERSIONS + 1)])
    return {number for number, entry in held.items() if entry.version in gone and entry.rows}


def _write_buckets(rows: DataFrame, path: str, version: int, table: BucketedTable, touched: int) -> tuple[DataFrame, dict[int, int]]:
    """Write each touched bucket as one folder, sorted by key; the rows as they are stored, and how many are in each."""
    placed = rows.repartition(max(1, touched), BUCKET).sortWithinPartitions(BUCKET, *table.spec.key)
    target = _folder(path, version, "rows")
    placed.write.partitionBy(BUCKET).parquet(target, compression=staging.COMPRESSION)
    schema = StructType([*table.spec.schema.fields, StructField(BUCKET, IntegerType())])
    stored = rows.sparkSession.read.schema(schema).parquet(target)
    return stored, {row[BUCKET]: row["count"] for row in stored.groupBy(BUCKET).count().collect()}


def _write_changes(paired: DataFrame, path: str, version: int, schema: StructType) -> None:
    """``ACTION``, ``OLD`` and ``NEW`` of the rows that differ."""
    sides = [F.when(F.col(side).isNotNull(), F.struct(*[F.col(f"{side}.{name}") for name in schema.names])).alias(side) for side in ("OLD", "NEW")]
    paired.filter("ACTION <> 'UNCHANGED'").select("ACTION", *sides).write.parquet(_folder(path, version, "changes"), compression=staging.COMPRESSION)


def _insert(new: DataFrame, path: str, version: int, table: BucketedTable, touched: int) -> tuple[dict[str, int], dict[int, int]]:
    """Write buckets of which the table has no row yet: there is nothing to pair, and what is stored tells the changes."""
    schema = table.spec.schema
    stored, written = _write_buckets(new, path, version, table, touched)
    inserted = stored.select(F.lit("INSERT").alias("ACTION"), F.lit(None).cast(schema).alias("OLD"), F.struct(*schema.names).alias("NEW"))
    _write_changes(inserted, path, version, schema)
    return {"INSERT_ROWS": sum(written.values())}, written


def _merge(old: DataFrame, new: DataFrame, path: str, version: int, table: BucketedTable, touched: int) -> tuple[dict[str, int], dict[int, int]]:
    """Pair the rows of buckets by key and write what differs and what becomes of them; the rows of each action and in each bucket."""
    paired = sync_rows.paired_rows(old.select(new.columns), new, [BUCKET, *table.spec.key], table.compare)
    merged, staged = staging.write_table(paired.select(BUCKET, "ACTION", "OLD", "NEW"), "merged", staging.COMPRESSION)
    counted = {f"{row['ACTION']}_ROWS": row["count"] for row in merged.groupBy("ACTION").count().collect()}
    _write_changes(merged, path, version, table.spec.schema)
    kept = F.when(F.col("ACTION") == "UNCHANGED", F.col("OLD")).otherwise(F.col("NEW"))  # which keeps its lineage
    rows = merged.filter("ACTION <> 'DELETE'").select(kept.alias("ROW")).select("ROW.*")
    written = _write_buckets(rows, path, version, table, touched)[1]
    staging.drop_table(rows.sparkSession, staged)
    return counted, written


def sync(spark: SparkSession, path: str, source: DataFrame, table: BucketedTable) -> dict[str, int]:
    """Bring the snapshot at ``path`` to the state of ``source``, a complete snapshot; returns what happened.

    One aggregate over the source gives a digest of each bucket. Only buckets whose digest differs from the manifest's are read
    from the source a second time, read from the table, matched by key, and written. Where the table has no row in them yet, as in a first
    version, they are written as they come. Keys must be unique, which is checked in those buckets, the others having passed before. Nothing is
    written when nothing differs.
    """
    current = snapshots.current_version(spark, path)
    held = manifest(spark, path, current) if current is not None else {}
    found = _digests(source, table)
    nothing = Entry(0, 0, (Decimal(0), Decimal(0)))
    numbers = held.keys() | found.keys()
    differ = {n for n in numbers if (held.get(n, nothing)[1:]) != (found.get(n, nothing)[1:])}
    summary = {f"{action}_ROWS": 0 for action in snapshots.ACTIONS}
    before, after = (sum(entry.rows for entry in entries.values()) for entries in (held, found))
    summary |= {"TARGET_ROWS": before, "FINAL_ROWS": after, "BUCKETS": len(numbers)}
    if current is not None and not differ:
        return summary | {"UNCHANGED_ROWS": before, "BUCKETS_READ": 0, "BUCKETS_WRITTEN": 0, "VERSION": current}

    touched = differ | _too_old(held)
    version = snapshots.next_version(spark, path)
    with snapshots.candidate(spark, path, version):
        schema = table.spec.schema
        number = table.number()
        new = source.select(*schema.names, number.alias(BUCKET))
        if found.keys() - touched:
            new = new.filter(number.isin(sorted(touched)))
        keys = quality.key_counts(new, table.spec.key)
        quality.require_none({f"DUPLICATE_KEY_{table.spec.name.upper()}": keys["DUPLICATE_KEYS"]}, table.spec.name)
        stored = {n: held[n] for n in touched if n in held and held[n].rows}
        if stored:
            counted, written = _merge(_read(spark, path, stored, schema), new, path, version, table, len(touched))
        else:
            counted, written = _insert(new, path, version, table, len(touched))
        summary |= counted
        for bucket in touched:
            quality.assert_row_count(written.get(bucket, 0), found.get(bucket, nothing).rows, f"{table.spec.name}, bucket {bucket}")
        entries = {n: held[n] for n in numbers - touched}
        entries |= {n: Entry(version, *found.get(n, nothing)[1:]) for n in touched}
        rows_of = [(n, entry.version, entry.rows, *entry.digest) for n, entry in sorted(entries.items())]
        spark.createDataFrame(rows_of, MANIFEST).coalesce(1).write.parquet(_folder(path, version, "manifest"))
    snapshots.publish(spark, path, version)
    summary["UNCHANGED_ROWS"] += sum(held[n].rows for n in numbers - touched)
    return summary | {"BUCKETS_READ": len(stored), "BUCKETS_WRITTEN": len(written), "VERSION": version}


def retire(spark: SparkSession, path: str, keep: int) -> list[int]:
    """Keep the ``keep`` newest published versions; remove the bucket folders that none of them points at, and what belongs to older versions alone.

    Returns the versions of which nothing is left.
    """
    published = snapshots.published_versions(spark, path)
    if keep < 1 or not published:
        return []
    live: dict[int, set[int]] = defaultdict(set)
    for version in published[-keep:]:
        for number, entry in manifest(spark, path, version).items():
            live[entry.version].add(number)
    gone = []
    for version in snapshots.all_versions(spark, path):
        if version in published[-keep:] or version > published[-1]:
            continue
        if not live[version]:
            snapshots.discard(spark, path, version)
            gone.append(version)
            continue
        rows = _folder(path, version, "rows")
        for name in snapshots.child_folders(spark, rows):
            if name.startswith(f"{BUCKET}=") and int(name.removeprefix(f"{BUCKET}=")) not in live[version]:
                staging.drop_table(spark, f"{rows}/{name}")
        _unpublish(spark, path, version, (snapshots.PUBLISHED, "changes", "manifest"))
    return gone


def _unpublish(spark: SparkSession, path: str, version: int, parts: Iterable[str]) -> None:
    """The marker goes first: without it the version is only a store of buckets."""
    for part in parts:
        staging.drop_table(spark, _folder(path, version, part))


def bucket_names(changes: DataFrame, table: BucketedTable, columns: Sequence[str]) -> DataFrame:
    """Changed rows with their bucket, by the row after the change or, for deletions, before it."""
    row = F.coalesce("NEW", "OLD")
    return changes.select("ACTION", *[row[name].alias(name) for name in columns]).withColumn(BUCKET, table.number())
