"""The registered queries: name -> (spark, data folder) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from datetime import UTC, date, datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from order_analytics import session
from order_analytics.functions.columns import offset_timestamp, short_id
from order_analytics.operators import conform, quality, staging, sync
from order_analytics.plans import facts, marts, order_sets, pipeline, refresh, reports
from order_analytics.plans.dataset import OrderDataset
from order_analytics.schemas import DATE_DIM, LINEAGE_FIELDS, ORDER_ITEM_OPTIONS, ORDER_ITEMS, TABLES, TableSpec
from order_analytics.sources import buckets, clustered, fixtures, footers, keyed, mart_store, pages, snapshots

Query = Callable[[SparkSession, str], DataFrame]

_open: dict[tuple, OrderDataset] = {}


def dataset(spark: SparkSession, sf_dir: str) -> OrderDataset:
    """The dataset of one folder, shared by the queries of a session until ``close_all``."""
    name = (spark.sparkContext.applicationId, id(spark), sf_dir)
    if name not in _open:
        session.use_utc(spark)
        _open[name] = OrderDataset(
            fixtures.order_items(spark, sf_dir), fixtures.order_item_options(spark, sf_dir)
        )
    return _open[name]


def close_all(spark: SparkSession) -> None:
    """Release every open dataset of the running application; forget those of earlier ones."""
    for name, opened in list(_open.items()):
        if name[0] == spark.sparkContext.applicationId:
            opened.release()
        del _open[name]


def on_dataset(build: Callable[[OrderDataset], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(dataset(spark, sf_dir))


def on_tables(build: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        session.use_utc(spark)
        return build(spark, sf_dir)

    return run


# --- facts ----------------------------------------------------------------------------------------

LINE_COLUMNS = [
    "ORDER_ID",
    "LINEITEM_ID",
    "RESTAURANT_ID",
    "CREATION_TIME_UTC",
    "USER_ID",
    "LOYALTY_FLAG",
    "ITEM_CATEGORY",
    "ITEM_NAME",
    "ITEM_QUANTITY",
    "OPTION_REVENUE",
    "HAS_ZERO_PRICE_OPTION",
    "OPTION_COUNT",
    "LINE_REVENUE",
]


def loyalty_normalized(data: OrderDataset) -> DataFrame:
    return facts.with_loyalty_flag(data.items).select("ORDER_ID", "LINEITEM_ID", "IS_LOYALTY", "LOYALTY_FLAG")


def line_sales_fact(data: OrderDataset) -> DataFrame:
    return data.line_sales.select(
        "ORDER_ID", "LINEITEM_ID", "RESTAURANT_ID", "ITEM_CATEGORY", "LINE_REVENUE", "ORDER_TIMESTAMP", "ORDER_DATE"
    )


def order_gaps(data: OrderDataset) -> DataFrame:
    return facts.order_gaps(data.customer_orders).select(
        "USER_ID", "ORDER_ID", "RESTAURANT_ID", "ORDER_TIMESTAMP", "ORDER_DATE", "PREVIOUS_ORDER_DATE", "GAP_DAYS"
    )


FACTS = {
    "option_fact": lambda d: facts.option_fact(d.options),
    "line_fact": lambda d: d.lines.select(LINE_COLUMNS),
    "order_fact": lambda d: d.orders,
    "customer_orders": lambda d: d.customer_orders,
    "customer_base": lambda d: facts.customer_base(d.customer_orders),
    "analysis_date": lambda d: facts.analysis_date(d.orders),
    "line_sales_fact": line_sales_fact,
    "loyalty_normalized": loyalty_normalized,
    "six_month_metrics": lambda d: facts.six_month_metrics(d.customer_orders, d.analysis_date),
    "order_gaps": order_gaps,
    "average_gaps": lambda d: facts.average_gaps(d.customer_orders),
    "spend_periods": lambda d: facts.spend_periods(d.customer_orders, d.analysis_date),
    "latest_customer_order": lambda d: facts.latest_customer_order(d.customer_orders),
    "customer_loyalty_stats": lambda d: marts.customer_loyalty_stats(d.profile),
}

MARTS = {
    "customer_clv": lambda d: d.customer_clv,
    "customer_rfm": lambda d: d.customer_rfm,
    "churn_indicators": lambda d: d.churn_indicators,
    "sales_trends_daily": lambda d: d.sales_trends_daily,
    "sales_trends_weekly": lambda d: d.sales_trends_weekly,
    "sales_trends_monthly": lambda d: d.sales_trends_monthly,
    "loyalty_program_impact": lambda d: d.loyalty_program_impact,
    "restaurant_performance": lambda d: d.restaurant_performance,
    "discount_effectiveness": lambda d: d.discount_effectiveness,
}


# --- conforming, merge and gates ------------------------------------------------------------------


def _typed(raw: DataFrame, spec: TableSpec, keep_originals: bool = False) -> DataFrame:
    named = conform.normalize_columns(raw)
    quality.check_columns(named, spec)
    return conform.cast_to_schema(named, spec, keep_originals)


def conform_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = _typed(fixtures.raw_order_items(spark, sf_dir), ORDER_ITEMS)
    return typed.withColumn("ITEM_PRICE", F.col("ITEM_PRICE").cast("double"))


def parse_offset_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = fixtures.offset_texts(spark, sf_dir)
    return texts.select("ORDER_ID", "LINEITEM_ID", offset_timestamp("RAW_TEXT").alias("PARSED_AT"))


def _joined_once(spark: SparkSession, sf_dir: str) -> tuple[staging.Stage, DataFrame]:
    """The lines that two snapshots are made of, written, so that each pass over a snapshot is a scan; and the stage that holds them."""
    stage = staging.Stage(spark)
    lines = stage.keep(fixtures.joined_lines(spark, sf_dir), "joined-lines")
    staging.forget_shuffles(spark)
    return stage, lines


def snapshot_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, lines = _joined_once(spark, sf_dir)
    older = fixtures.earlier_order_items(spark, sf_dir, lines)
    newer = fixtures.later_order_items(spark, sf_dir, lines)
    return sync.snapshot_changes(older, newer, ORDER_ITEMS.key, ORDER_ITEMS.business_columns)


def _flawed_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _typed(fixtures.flawed_order_items(spark, sf_dir), ORDER_ITEMS, keep_originals=True)


def _flawed_casts(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    raw = {
        "order_items": fixtures.flawed_order_items,
        "order_item_options": fixtures.flawed_options,
        "date_dim": fixtures.flawed_date_dim,
    }
    return {name: _typed(build(spark, sf_dir), TABLES[name], keep_originals=True) for name, build in raw.items()}


def _by_table(checks: dict[str, DataFrame]) -> DataFrame:
    named = [check.select(F.lit(name).alias("TABLE"), "RULE", "VIOLATIONS") for name, check in checks.items()]
    return reduce(DataFrame.unionByName, named)


def gate_cast_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = _flawed_casts(spark, sf_dir)
    return _by_table({name: quality.run_checks(df, quality.cast_rules(TABLES[name])) for name, df in typed.items()})


def gate_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = _flawed_casts(spark, sf_dir)
    return _by_table({name: quality.run_checks(df, quality.key_rules(TABLES[name])) for name, df in typed.items()})


def _conflicting(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    typed = {name: conform.drop_originals(df) for name, df in _flawed_casts(spark, sf_dir).items()}
    typed["order_items"] = fixtures.coarse_order_items(spark, sf_dir)
    return {name: conform.drop_exact_duplicates(df) for name, df in typed.items()}


def gate_conflicting_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _by_table(
        {
            name: quality.count_duplicate_keys(df, TABLES[name].key, f"DUPLICATE_KEY_{name.upper()}")
            for name, df in _conflicting(spark, sf_dir).items()
        }
    )


def gate_unsafe_join_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    coarse = fixtures.coarse_order_items(spark, sf_dir)
    return quality.count_duplicate_keys(coarse, facts.LINE_KEY, "UNSAFE_OPTION_JOIN_KEY")


def gate_revenue_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = quality.run_checks(_flawed_cast(spark, sf_dir), quality.item_revenue_rules())
    options = _flawed_casts(spark, sf_dir)["order_item_options"]
    return items.unionByName(quality.run_checks(options, quality.option_revenue_rules()))


def gate_invalid_loyalty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.invalid_loyalty_values(_flawed_cast(spark, sf_dir))


def gate_order_consistency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.order_consistency_checks(_flawed_cast(spark, sf_dir))


def conflicting_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    coarse = conform.drop_exact_duplicates(fixtures.coarse_order_items(spark, sf_dir))
    columns = ["ORDER_ID", "LINEITEM_ID", "RESTAURANT_ID", "CREATION_TIME_UTC", "ITEM_NAME", "ITEM_QUANTITY"]
    return quality.conflicting_records(coarse, ORDER_ITEMS.key).select(columns)


def conflicting_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    options = _conflicting(spark, sf_dir)["order_item_options"].select(ORDER_ITEM_OPTIONS.business_columns)
    return quality.conflicting_records(options, ORDER_ITEM_OPTIONS.key)


def orphan_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.orphan_options(fixtures.order_items_with_gaps(spark, sf_dir), fixtures.order_item_options(spark, sf_dir))


def schema_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The closed schema of each typed table, as the check has it, beside the columns of its source."""
    raw = {"order_items": fixtures.raw_order_items, "order_item_options": fixtures.raw_options, "date_dim": fixtures.raw_date_dim}
    found = []
    for name, build in raw.items():
        named = conform.normalize_columns(build(spark, sf_dir))
        quality.check_columns(named, TABLES[name])
        found.append(named.agg(F.count("*").alias("ROWS")).select(F.lit(name).alias("TABLE"), F.lit(len(named.columns)).alias("COLUMNS"), "ROWS"))
    return reduce(DataFrame.unionByName, found)


def lineage_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    stamped = snapshots.add_lineage(fixtures.order_item_options(spark, sf_dir), datetime(2026, 1, 1, tzinfo=UTC), "order_item_options", "FULL_DAILY")
    return stamped.groupBy("_INGESTED_AT", "_SOURCE_TABLE", "_LOAD_TYPE").agg(F.count("*").alias("ROWS"))


def _pipeline_sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    lineage = ["_ingested_at", "_source table", "_Load-Type"]
    raw = {"date_dim": fixtures.raw_date_dim, "order_item_options": fixtures.raw_options, "order_items": fixtures.raw_order_items}
    return {name: build(spark, sf_dir).drop(*lineage) for name, build in raw.items()}


def pipeline_run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole chain from raw tables to published marts, by those counts of its summary that are not zero."""
    summary = pipeline.run(spark, _pipeline_sources(spark, sf_dir), staging.new_path(spark, "pipeline"))
    return summary.filter("VALUE <> 0")


def mart_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mart as it is read back after it was written, gated and published."""
    data, root = dataset(spark, sf_dir), staging.new_path(spark, "marts")
    generated_at = datetime(2026, 1, 1, tzinfo=UTC)
    rows = mart_store.write_mart(data.customer_rfm, root, 1, "customer_rfm", data.analysis_date, generated_at)
    quality.assert_row_count(mart_store.read_mart(spark, root, "customer_rfm", 1).count(), rows, "customer_rfm")
    snapshots.publish(spark, root, 1)
    return mart_store.read_mart(spark, root, "customer_rfm")


def snapshot_initial_sync(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A first and a second equal snapshot: all rows are inserted, then none is changed."""
    path = staging.new_path(spark, "snapshot")
    typed = _typed(fixtures.raw_options(spark, sf_dir), ORDER_ITEM_OPTIONS)
    runs = [sync.sync(spark, path, typed, ORDER_ITEM_OPTIONS, ORDER_ITEM_OPTIONS.business_columns) for _ in range(2)]
    rows = [(number, name, int(value)) for number, run in enumerate(runs, 1) for name, value in run.items()]
    return spark.createDataFrame(rows, "RUN int, METRIC string, VALUE bigint")


def post_merge_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and conflicting keys of a merged snapshot."""
    path = staging.new_path(spark, "merged")
    for build in (fixtures.earlier_order_items, fixtures.later_order_items):
        lineage = {field.name: F.lit(None).cast(field.dataType) for field in LINEAGE_FIELDS}
        sync.sync(spark, path, build(spark, sf_dir).withColumns(lineage), ORDER_ITEMS)
    return quality.key_summary(snapshots.read_current(spark, path), ORDER_ITEMS.key)


#: Buckets in a month of order lines.
SYNC_BUCKETS = 4


def sync_changed_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second snapshot in key buckets: what it changed, row by row, with the bucket and what the sync counted beside it."""
    path = staging.new_path(spark, "bucketed")
    table = buckets.BucketedTable.of(ORDER_ITEMS, SYNC_BUCKETS, period="CREATION_TIME_UTC")
    lineage = {field.name: F.lit(None).cast(field.dataType) for field in LINEAGE_FIELDS}
    stage, lines = _joined_once(spark, sf_dir)
    for build in (fixtures.order_items_before_the_last_week, fixtures.order_items_after_the_last_week):
        summary = buckets.sync(spark, path, build(spark, sf_dir, lines).withColumns(lineage), table)
        staging.forget_shuffles(spark)
    stage.release()
    changes = buckets.read_changes(spark, path, summary["VERSION"], ORDER_ITEMS.schema)
    named = buckets.bucket_names(changes, table, ORDER_ITEMS.key)
    counted = ("UNCHANGED_ROWS", "FINAL_ROWS", "BUCKETS_READ", "BUCKETS_WRITTEN")
    return named.withColumns({name: F.lit(summary[name]).cast("bigint") for name in counted})


#: Buckets of the line key at least; more where the session's shuffles need more, so that a bucket stays one task's worth.
KEYED_BUCKETS = 8


def _keyed_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Two snapshots of the lines and the options in buckets of the line key, in a session for work on keys."""
    own = keyed.key_session(spark)
    stage, lines = _joined_once(own, sf_dir)
    built = {
        "older": (fixtures.earlier_order_items(own, sf_dir, lines), ORDER_ITEMS.key),
        "newer": (fixtures.later_order_items(own, sf_dir, lines), ORDER_ITEMS.key),
        "options": (fixtures.repeated_options(own, sf_dir), ORDER_ITEM_OPTIONS.key),
    }
    number = max(KEYED_BUCKETS, int(own.conf.get("spark.sql.shuffle.partitions")))
    distinct = {name: (conform.drop_exact_duplicates(rows, placed=(number, facts.LINE_KEY)), key) for name, (rows, key) in built.items()}
    tables = keyed.write_all(distinct, staging.new_path(spark, "keyed"), facts.LINE_KEY, number)
    stage.release()
    return tables


def keyed_work(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """All that the pipeline does by key, on tables laid out by it: gates, merge, option join, orphans."""
    older, newer, options = (tables[name] for name in ("older", "newer", "options"))
    lines = facts.line_fact(newer, options)
    return {
        "ITEM_KEYS": quality.key_summary(newer, ORDER_ITEMS.key),
        "OPTION_KEYS": quality.key_summary(options, ORDER_ITEM_OPTIONS.key),
        "JOIN_KEYS": quality.key_summary(newer, facts.LINE_KEY),
        "MERGE": sync.change_summary(sync.snapshot_changes(older, newer, ORDER_ITEMS.key, ORDER_ITEMS.business_columns)),
        "LINES": lines.agg(
            F.count(F.lit(1)).alias("ROWS"),
            F.sum("OPTION_COUNT").alias("OPTIONS"),
            F.sum(F.col("LINE_REVENUE") * 100).cast("bigint").alias("REVENUE_CENTS"),
        ),
        "ORPHANS": facts.orphan_options(newer, options).agg(F.count(F.lit(1)).alias("ROWS")),
    }


def keyed_key_work(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The figures of ``keyed_work``, one in a row."""
    steps = keyed_work(_keyed_tables(spark, sf_dir))
    figures = [df.unpivot([], df.columns, "METRIC", "VALUE").select(F.lit(step).alias("STEP"), "METRIC", "VALUE") for step, df in steps.items()]
    return reduce(DataFrame.unionByName, figures)


def _figures(state: refresh.MartState) -> DataFrame:
    """The additive marts of a state in one shape: MART, KEY, revenue, orders, one more count and a label."""

    def shaped(name: str, key: str, revenue: str, orders: str, other: str, label: str) -> DataFrame:
        columns = {"MART": f"'{name}'", "KEY": key, "TOTAL_REVENUE": revenue, "ORDER_COUNT": orders, "OTHER": f"cast({other} AS bigint)", "LABEL": label}
        return _select_exprs(state.mart(name), columns)

    trend = "concat_ws('|', PERIOD_START_DATE, RESTAURANT_ID, coalesce(ITEM_CATEGORY, ''))"
    span = "concat_ws('|', FIRST_ORDER_DATE, LAST_ORDER_DATE, REVENUE_RANK, REVENUE_PER_USER)"
    average = "cast(AVG_LIFETIME_REVENUE_PER_USER AS string)"
    figures = [shaped(name, trend, "TOTAL_REVENUE", "ORDER_COUNT", "ITEM_QUANTITY", "''") for name in ("sales_trends_daily", *refresh.PERIODS)]
    figures += [
        shaped("churn_indicators", "USER_ID", "CURRENT_30_DAY_SPEND", "LIFETIME_ORDER_COUNT", "DAYS_SINCE_LAST_ORDER", "CHURN_STATUS"),
        shaped("loyalty_program_impact", "LOYALTY_STATUS", "TOTAL_REVENUE", "ORDER_COUNT", "USER_COUNT", average),
        shaped("restaurant_performance", "RESTAURANT_ID", "TOTAL_REVENUE", "ORDER_COUNT", "USER_COUNT", span),
        shaped("discount_effectiveness", "DISCOUNT_STATUS", "TOTAL_REVENUE", "ORDER_COUNT", "USER_COUNT", "''"),
    ]
    return reduce(DataFrame.unionByName, figures)


def _select_exprs(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.select(*[F.expr(text).alias(name) for name, text in columns.items()])


def mart_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Marts of an earlier snapshot brought up to date from what a later one changed: lines and options come, go and change."""
    stage = staging.Stage(spark)
    lines = stage.keep(fixtures.joined_lines(spark, sf_dir), "joined-lines")
    items = [build(spark, sf_dir, lines) for build in (fixtures.order_items_before_the_last_week, fixtures.order_items_after_the_last_week)]
    later = fixtures.order_item_options(spark, sf_dir)
    options = [later.filter(~F.col("LINEITEM_ID").endswith("00")), later]
    state = refresh.build(items[0], options[0])
    changes = [
        sync.changed_rows(*items, ORDER_ITEMS.key, ORDER_ITEMS.business_columns, "ORDER_ID", stage),
        sync.changed_rows(*options, ORDER_ITEM_OPTIONS.key, ORDER_ITEM_OPTIONS.business_columns, "ORDER_ID", stage),
    ]
    return _figures(refresh.refresh(state, items[1], options[1], changes))


def coerced_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = conform.normalize_columns(fixtures.flawed_order_items(spark, sf_dir))
    texts = raw.withColumn("CREATION_TIME_UTC", F.regexp_replace("CREATION_TIME_UTC", r" \+00:00$", ""))
    coerced = conform.coerce(texts, numeric=["ITEM_QUANTITY", "NO_SUCH_COLUMN"], dates=["CREATION_TIME_UTC"])
    return coerced.select("ORDER_ID", "LINEITEM_ID", "ITEM_NAME", "ITEM_QUANTITY", "CREATION_TIME_UTC")


TABLE_QUERIES = {
    "conform_order_items": conform_order_items,
    "conform_options": lambda s, d: _typed(fixtures.raw_options(s, d), ORDER_ITEM_OPTIONS),
    "conform_date_dim": lambda s, d: _typed(fixtures.raw_date_dim(s, d), DATE_DIM),
    "parse_offset_timestamps": parse_offset_timestamps,
    "exact_dedup": lambda s, d: conform.drop_exact_duplicates(fixtures.repeated_options(s, d)),
    "snapshot_sync_changes": snapshot_changes,
    "snapshot_sync_summary": lambda s, d: sync.change_summary(snapshot_changes(s, d)),
    "conflicting_records": conflicting_records,
    "conflicting_options": conflicting_options,
    "orphan_options": orphan_options,
    "schema_check": schema_check,
    "lineage_columns": lineage_columns,
    "pipeline_run_summary": pipeline_run_summary,
    "mart_round_trip": mart_round_trip,
    "snapshot_initial_sync": snapshot_initial_sync,
    "post_merge_checks": post_merge_checks,
    "sync_changed_buckets": sync_changed_buckets,
    "mart_refresh": mart_refresh,
    "keyed_key_work": keyed_key_work,
    "gate_cast_failures": gate_cast_failures,
    "gate_null_keys": gate_null_keys,
    "gate_conflicting_keys": gate_conflicting_keys,
    "gate_unsafe_join_keys": gate_unsafe_join_keys,
    "gate_revenue_nulls": gate_revenue_nulls,
    "gate_invalid_loyalty": gate_invalid_loyalty,
    "gate_order_consistency": gate_order_consistency,
    "coerced_types": coerced_types,
}

def _broken_scores(rfm: DataFrame) -> DataFrame:
    """Scores as a wrong rule would give them to some customers without recent orders."""
    odd = F.col("RECENCY_DAYS") % 2 == 1
    return rfm.withColumns({name: F.when(odd, F.col(name) + 1).otherwise(F.col(name)) for name in ("F_SCORE", "M_SCORE")})


def _broken_spans(restaurants: DataFrame) -> DataFrame:
    """Spans as a wrong order of dates would give them to some restaurants."""
    odd = F.col("ORDER_COUNT") % 2 == 1
    names = ("ACTIVE_CALENDAR_DAYS", "ACTIVE_CALENDAR_WEEKS")
    return restaurants.withColumns({name: F.when(odd, 1 - F.col(name)).otherwise(F.col(name)) for name in names})


MART_GATES = {
    "gate_rfm_scores": lambda d: quality.run_checks(_broken_scores(d.customer_rfm), quality.rfm_rules()),
    "gate_restaurant_spans": lambda d: quality.run_checks(_broken_spans(d.restaurant_performance), quality.span_rules()),
    "user_id_diagnostics": lambda d: quality.user_id_diagnostics(d.orders),
    "rfm_segment_counts": lambda d: quality.rfm_segment_counts(d.customer_rfm),
}


# --- reports --------------------------------------------------------------------------------------

SEVERAL_CATEGORIES = ["ECONOMY", "SMALL", "UNKNOWN"]
ONE_CATEGORY = ["ECONOMY"]
TREND_START, TREND_END = date(1996, 1, 1), date(2000, 12, 31)
FOCUS_RESTAURANT = "R007"
SEVERAL_RESTAURANTS = ["R001", "R007", "R013"]
SEVERAL_SEGMENTS = ["VIP", "CHURN_RISK"]


def _chosen(data: OrderDataset, categories: list[str] | None = None) -> DataFrame:
    return reports.filter_trends(data.sales_trends_daily, categories=categories, start=TREND_START, end=TREND_END)


def overview_kpis(data: OrderDataset) -> DataFrame:
    return reports.overview_kpis(
        data.customer_clv,
        data.customer_rfm,
        data.churn_indicators,
        data.sales_trends_monthly,
        data.loyalty_program_impact,
        data.restaurant_performance,
        data.discount_effectiveness,
    )


PAGE_SIZE = 25
PAGE_KEYS = (pages.Key("RECENCY_DAYS", descending=True), pages.Key("USER_ID"))
TREND_COLUMNS = ["PERIOD_START_DATE", "RESTAURANT_ID", "ITEM_CATEGORY", "TOTAL_REVENUE", "ORDER_COUNT", "ITEM_QUANTITY", "AVERAGE_ORDER_VALUE"]


def _paged(data: OrderDataset) -> pages.SortedTable:
    rows = data.customer_rfm.select("USER_ID", "RECENCY_DAYS", "RFM_SEGMENT")
    path = staging.new_path(data.spark, "paged")
    data.stage.track(path)
    return pages.write(rows, PAGE_KEYS, path, files=8)


def customer_page(data: OrderDataset) -> DataFrame:
    """The third page of customers by recency."""
    return _paged(data).page(2, PAGE_SIZE)


def customers_after(data: OrderDataset) -> DataFrame:
    """The page that follows a given recency and user."""
    return _paged(data).after((200, "C5"), PAGE_SIZE)


def orders_of_categories(data: OrderDataset) -> DataFrame:
    """Distinct orders a month with lines of any of several categories, which the trend marts cannot tell."""
    month = F.trunc("PERIOD_START_DATE", "month").alias("PERIOD_START_DATE")
    return order_sets.order_counts(data.order_sets, [month, "RESTAURANT_ID"], SEVERAL_CATEGORIES)


def trend_clustered(data: OrderDataset) -> DataFrame:
    """A filter on the daily trend as it is read from clustered files."""
    path = staging.new_path(data.spark, "clustered")
    data.stage.track(path)
    trend = reports.with_category(data.sales_trends_daily).select(TREND_COLUMNS)
    clustered.write(trend, ["PERIOD_START_DATE", "RESTAURANT_ID", "ITEM_CATEGORY"], path, files=4)
    stored = data.spark.read.schema(trend.schema).parquet(path)
    days = F.col("PERIOD_START_DATE").between(F.lit(TREND_START), F.lit(TREND_END))
    return stored.filter(F.col("ITEM_CATEGORY").isin(SEVERAL_CATEGORIES) & days)


def footer_summary(data: OrderDataset) -> DataFrame:
    """Rows and span of the stored daily trend, from the files' footers."""
    path = staging.new_path(data.spark, "daily")
    data.stage.track(path)
    data.sales_trends_daily.write.parquet(path)
    return footers.summary(data.spark, path, ["PERIOD_START_DATE", "ORDER_COUNT"])


def short_ids(data: OrderDataset) -> DataFrame:
    return data.orders.select("USER_ID").distinct().select("USER_ID", short_id("USER_ID").alias("USER_ID_DISPLAY"))


REPORTS = {
    "overview_kpis": overview_kpis,
    "overview_top5_trend": lambda d: reports.overview_top_trend(d.sales_trends_monthly),
    "clv_kpis": lambda d: reports.clv_kpis(d.customer_clv, d.revenue_percentiles),
    "clv_segment_distribution": lambda d: reports.clv_segment_distribution(d.customer_clv),
    "clv_histogram": lambda d: reports.clv_histogram(d.customer_clv, percentiles=d.revenue_percentiles),
    "top_customers": lambda d: reports.top_customers(d.customer_clv),
    "rfm_segment_distribution": lambda d: reports.rfm_segment_distribution(d.customer_rfm),
    "rfm_table": lambda d: reports.rfm_table(d.customer_rfm),
    "churn_kpis": lambda d: reports.churn_kpis(d.churn_indicators),
    "churn_status_counts": lambda d: reports.churn_status_counts(d.churn_indicators),
    "at_risk_customers": lambda d: reports.at_risk_customers(d.churn_indicators),
    "trend_filter_values": lambda d: reports.filter_values(d.sales_trends_daily),
    "trend_filtered": lambda d: _chosen(d, SEVERAL_CATEGORIES),
    "trend_kpis_single_category": lambda d: reports.trend_kpis(_chosen(d, ONE_CATEGORY), len(ONE_CATEGORY)),
    "trend_kpis_all_categories": lambda d: reports.trend_kpis(reports.with_category(d.sales_trends_weekly), 0),
    "revenue_over_time": lambda d: reports.revenue_over_time(reports.with_category(d.sales_trends_monthly)),
    "orders_over_time": lambda d: reports.orders_over_time(
        reports.filter_trends(d.sales_trends_daily, categories=ONE_CATEGORY), len(ONE_CATEGORY)
    ),
    "category_revenue": lambda d: reports.category_revenue(reports.filter_trends(d.sales_trends_daily)),
    "trend_top_restaurants": lambda d: reports.trend_top_restaurants(reports.filter_trends(d.sales_trends_daily)),
    "trend_of_restaurants": lambda d: reports.filter_trends(d.sales_trends_monthly, restaurants=SEVERAL_RESTAURANTS),
    "rfm_table_of_segments": lambda d: reports.rfm_table(d.customer_rfm, SEVERAL_SEGMENTS),
    "loyalty_member_share": lambda d: reports.loyalty_member_share(d.loyalty_program_impact),
    "loyalty_spend_unpivot": lambda d: reports.loyalty_spend_unpivot(d.loyalty_program_impact),
    "restaurant_kpis": lambda d: reports.restaurant_kpis(d.restaurant_performance),
    "restaurant_focus": lambda d: reports.restaurant_focus(d.restaurant_performance, FOCUS_RESTAURANT),
    "restaurant_table": lambda d: reports.restaurant_table(d.restaurant_performance),
    "top_restaurants": lambda d: reports.top_restaurants(d.restaurant_performance),
    "bottom_restaurants": lambda d: reports.bottom_restaurants(d.restaurant_performance),
    "discount_kpis": lambda d: reports.discount_kpis(d.discount_effectiveness),
    "short_ids": short_ids,
    "customer_page": customer_page,
    "customers_after": customers_after,
    "orders_of_categories": orders_of_categories,
    "trend_clustered": trend_clustered,
    "footer_summary": footer_summary,
}


def queries() -> dict[str, Query]:
    shared = FACTS | MARTS | MART_GATES | REPORTS
    return {name: on_dataset(build) for name, build in shared.items()} | {
        name: on_tables(build) for name, build in TABLE_QUERIES.items()
    }
