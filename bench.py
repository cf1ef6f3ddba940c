"""Times the headline queries and prints one JSON line.

Each query is measured from the raw Parquet tables: what earlier queries staged is released before it
starts. ``all_marts`` builds the nine marts over one shared dataset, as the pipeline does, and
``pipeline_run_summary`` is the whole chain from raw tables to published marts. Results go to the no-op sink, so every row
is computed and none is brought to the driver. Staged tables go to a shared folder, as on a cluster.

All entries run once, then again up to ``BENCH_ROUNDS`` times (3) while less than ``BENCH_SECONDS`` (600) have passed; the median counts,
and ``spread`` has the largest ratio of slowest to fastest.
"""

from __future__ import annotations

import json
import os
import tempfile
import time
from statistics import median

from order_analytics import registry
from order_analytics.session import build_session
from order_analytics.sources.mart_store import MARTS

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
ROUNDS, SECONDS = int(os.environ.get("BENCH_ROUNDS", "3")), float(os.environ.get("BENCH_SECONDS", "600"))

HEADLINE = (
    *MARTS,
    "order_fact",
    "line_fact",
    "order_gaps",
    "overview_kpis",
    "clv_kpis",
    "conform_order_items",
    "snapshot_sync_summary",
    "gate_unsafe_join_keys",
    "gate_order_consistency",
    "pipeline_run_summary",
)


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    spark = build_session(
        "bench",
        f"local[{CPUS}]",
        spark__sql__shuffle__partitions=CPUS,
        spark__ui__enabled="false",
        spark__driver__memory="16g",
        spark__checkpoint__dir=tempfile.mkdtemp(prefix="bench-"),
        # the test tables are small: let AQE keep one partition per core
        spark__sql__adaptive__coalescePartitions__minPartitionSize="64k",
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = registry.queries()

    def cold(name: str) -> float:
        registry.close_all(spark)
        return timed(lambda: run(queries[name](spark, SF_DIR)))

    def all_marts() -> None:
        for name in MARTS:
            run(queries[name](spark, SF_DIR))

    all_marts()  # lets the JVM compile the hot code first
    taken: dict[str, list[float]] = {}
    began = time.perf_counter()
    for number in range(ROUNDS):
        if number and time.perf_counter() - began > SECONDS:
            break
        for name in HEADLINE:
            taken.setdefault(name, []).append(cold(name))
        registry.close_all(spark)
        taken.setdefault("all_marts", []).append(timed(all_marts))
    registry.close_all(spark)
    times = {name: round(median(seconds), 3) for name, seconds in taken.items()}
    spread = max(max(seconds) / min(seconds) for seconds in taken.values())
    print(
        json.dumps(
            {
                "metric": "headline queries, each from raw tables",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "rounds": len(taken["all_marts"]),
                "spread": round(spread, 2),
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
