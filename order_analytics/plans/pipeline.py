"""End to end: source tables -> raw snapshots -> typed snapshots -> marts."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import LongType, StringType, StructField, StructType

from order_analytics import session
from order_analytics.operators import conform, quality, sync
from order_analytics.plans import facts
from order_analytics.plans.dataset import OrderDataset
from order_analytics.schemas import DATE_DIM, ORDER_ITEM_OPTIONS, ORDER_ITEMS, TABLES, TableSpec
from order_analytics.sources import buckets, mart_store, snapshots

# The load types a batch may have.
LOAD_TYPES = ("FULL_INITIAL", "FULL_DAILY")

#: Published versions of each table and of the marts that stay after a run.
KEPT_VERSIONS = 2

SUMMARY_SCHEMA = StructType(
    [StructField("STEP", StringType()), StructField("TABLE", StringType()), StructField("METRIC", StringType()),
     StructField("VALUE", LongType())]
)


class RunSummary:
    """Row counts and checks of a run, as they were observed."""

    def __init__(self):
        self._rows: list[tuple[str, str, str, int]] = []

    def add(self, step: str, table: str, **metrics: int) -> None:
        self._rows += [(step, table, metric, value) for metric, value in metrics.items()]

    def value(self, step: str, table: str, metric: str) -> int:
        return next(value for *name, value in self._rows if name == [step, table, metric])

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self._rows, SUMMARY_SCHEMA)


def snapshot_tables(
    sources: Mapping[str, DataFrame], root: str, load_type: str, summary: RunSummary, ingested_at: datetime | None = None
) -> None:
    """Write each source table as a new raw snapshot, with one ingestion time for the batch."""
    if load_type not in LOAD_TYPES:
        raise ValueError(f"Load type {load_type!r} is none of {LOAD_TYPES}")
    batch_time = ingested_at or datetime.now(UTC)
    for name, source in sources.items():
        path = f"{root}/{name}"
        stamped = snapshots.add_lineage(source, batch_time, name, load_type)
        version, rows = snapshots.write_candidate(stamped, path)
        with snapshots.candidate(source.sparkSession, path, version):
            stored = snapshots.read_version(source.sparkSession, path, version).count()
            quality.assert_row_count(stored, rows, name)
        snapshots.publish(source.sparkSession, path, version)
        snapshots.retire(source.sparkSession, path, KEPT_VERSIONS)
        summary.add("ingest", name, ROWS=rows)


def conform_table(raw: DataFrame, spec: TableSpec, summary: RunSummary) -> DataFrame:
    """Typed and deduplicated rows of one raw table, once its row rules hold."""
    named = conform.normalize_columns(raw)
    quality.check_columns(named, spec)
    cast = conform.cast_to_schema(named, spec, keep_originals=True)
    rules = quality.cast_rules(spec) | quality.key_rules(spec)
    counts = quality.enforce_rows(cast, rules, spec.name, reported=quality.rounding_rules(spec), identity=spec.schema.names)
    repeated = counts.pop("REPEATED_DIGESTS")
    summary.add("conform", spec.name, **counts)
    return conform.drop_exact_duplicates(conform.drop_originals(cast), suspected=repeated > 0)


def bucketed(spec: TableSpec, number: int) -> buckets.BucketedTable:
    """Order lines in ``number`` buckets a month, options in as many for the whole table; the calendar is one."""
    if spec is ORDER_ITEMS:
        return buckets.BucketedTable.of(spec, number, period="CREATION_TIME_UTC")
    return buckets.BucketedTable.of(spec, 1 if spec is DATE_DIM else number)


def read_typed(spark: SparkSession, typed_root: str, spec: TableSpec, key_buckets: int | None = None) -> DataFrame:
    """The business columns of a typed table's current version."""
    read = buckets.read_current if key_buckets else snapshots.read_current
    return read(spark, f"{typed_root}/{spec.name}", spec.schema).select(spec.business_columns)


def conform_tables(spark: SparkSession, raw_root: str, typed_root: str, summary: RunSummary, key_buckets: int | None = None) -> None:
    """Gate every raw snapshot and sync it into its typed snapshot; lineage alone makes no row an update.

    With ``key_buckets`` the typed tables are kept in that many buckets, and a sync rewrites only those that changed.
    """
    session.use_utc(spark)
    session.size_shuffles(spark, session.folder_bytes(spark, raw_root))
    for name, spec in TABLES.items():
        typed = conform_table(snapshots.read_current(spark, f"{raw_root}/{name}"), spec, summary)
        path = f"{typed_root}/{name}"
        if key_buckets:
            synced = buckets.sync(spark, path, typed, bucketed(spec, key_buckets))
        else:
            synced = sync.sync(spark, path, typed, spec, compare=spec.business_columns)
        removed = summary.value("conform", name, "ROWS") - synced["FINAL_ROWS"]
        summary.add("sync", name, EXACT_DUPLICATES=removed, **synced)
        (buckets if key_buckets else snapshots).retire(spark, path, KEPT_VERSIONS)


def gate_mart_inputs(items: DataFrame, options: DataFrame) -> dict[str, int]:
    """What the facts rely on: unique option join keys, complete prices, known loyalty words."""
    item_rules = quality.item_revenue_rules() | quality.loyalty_rules()
    keys = quality.key_counts(items, facts.LINE_KEY)
    found = quality.require_none({"UNSAFE_OPTION_JOIN_KEY": keys["DUPLICATE_KEYS"]}, "order_items")
    checks = [
        (quality.run_checks(items, item_rules), "order_items"),
        (quality.run_checks(options, quality.option_revenue_rules()), "order_item_options"),
    ]
    for check, table in checks:
        found |= quality.enforce(check, table)
    return found


def build_marts(spark: SparkSession, typed_root: str, mart_root: str, summary: RunSummary, key_buckets: int | None = None) -> None:
    """Gate the typed tables, derive the facts once, and write all marts."""
    items, options = (read_typed(spark, typed_root, spec, key_buckets) for spec in (ORDER_ITEMS, ORDER_ITEM_OPTIONS))
    summary.add("gate", "mart inputs", **gate_mart_inputs(items, options))
    dataset = OrderDataset(items, options)
    try:
        summary.add("gate", "orders", **quality.enforce_order_consistency(items, "orders"))
        summary.add("profile", "orders", **quality.user_id_diagnostics(dataset.orders).first().asDict())
        summary.add("profile", "order_item_options", ORPHANS=facts.orphan_options(items, options).count())
        version = snapshots.next_version(spark, mart_root)
        with snapshots.candidate(spark, mart_root, version):
            write_marts(dataset, mart_root, version, summary)
        snapshots.publish(spark, mart_root, version)
        snapshots.retire(spark, mart_root, KEPT_VERSIONS)
    finally:
        dataset.release()


def write_marts(dataset: OrderDataset, mart_root: str, version: int, summary: RunSummary) -> None:
    """Write all marts as an unpublished version and gate what was written."""
    gated = {"customer_rfm": quality.rfm_rules(), "restaurant_performance": quality.span_rules()}
    generated_at = datetime.now(UTC)
    for name in mart_store.MARTS:
        mart = getattr(dataset, name)
        rows = mart_store.write_mart(mart, mart_root, version, name, dataset.analysis_date, generated_at)
        summary.add("mart", name, ROWS=rows)
        if name in gated:
            written = mart_store.read_mart(dataset.spark, mart_root, name, version)
            summary.add("gate", name, **quality.enforce(quality.run_checks(written, gated[name]), name))
    segments = quality.rfm_segment_counts(mart_store.read_mart(dataset.spark, mart_root, "customer_rfm", version))
    summary.add("profile", "customer_rfm", **{row["RFM_SEGMENT"]: row["USER_COUNT"] for row in segments.collect()})


def run(
    spark: SparkSession,
    sources: Mapping[str, DataFrame],
    root: str,
    load_type: str = "FULL_DAILY",
    key_buckets: int | None = None,
) -> DataFrame:
    """The whole chain under ``root``; returns the run summary. ``key_buckets`` as in ``conform_tables``, the same for all runs of a root."""
    session.use_utc(spark)
    summary = RunSummary()
    snapshot_tables(sources, f"{root}/raw", load_type, summary)
    conform_tables(spark, f"{root}/raw", f"{root}/typed", summary, key_buckets)
    build_marts(spark, f"{root}/typed", f"{root}/marts", summary, key_buckets)
    return summary.frame(spark)
