"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR   tables to read (default /root/testdata/sf0.1)
BENCH_CPUS     local cores (default: all)
BENCH_COPIES   also run on the event log repeated this often (default 0: not)
BENCH_QUERIES  comma-separated names to run instead of the headline set
BENCH_RUNS     runs per query, the fastest counts (default 2: the first compiles)
"""

from __future__ import annotations

import json
import os
import re
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.plans import catalog
from tidemark.session import prepare, scratch

HEADLINE = (
    "latest_snapshot",
    "live_snapshot",
    "latest_by_join",
    "incremental_snapshot",
    "upsert_snapshot",
    "snapshot_manifest",
    "compare_snapshots",
    "check_contiguity",
    "verify_events",
    "file_stats",
    "problem_files",
    "verify_landing",
    "missing_ranges",
    "duplicate_ranges",
    "timepoint_issues",
    "order_breaks",
    "update_file_index",
    "replay_events",
    "overlap_recommendation",
    "confirm_double_load",
    "accounts_dedup",
    "register_latest_filing",
    "scan_events",
    "load_events",
    "classify_files",
    "repair_outcomes",
    "export_snapshot",
)

# Those that read nothing but the event log and write no files.
ON_LOG = HEADLINE[:20]


def timed(run: Callable[[], DataFrame]) -> float:
    seconds = []
    for _ in range(int(os.environ.get("BENCH_RUNS", "2"))):
        start = time.perf_counter()
        run().write.format("noop").mode("overwrite").save()
        seconds.append(time.perf_counter() - start)
    return round(min(seconds), 3)


def copies(spark: SparkSession, sf_dir: str, n: int) -> str:
    """The event log ``n`` times in a row, stored like the original."""
    out = scratch(spark, "copies")
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    size = events.count()
    (
        events.selectExpr(f"explode(sequence(0, {n - 1})) as copy", "*")
        .selectExpr(
            f"event_id + copy * {size}L as event_id", "ts", "user_id", "event_type", "value", "props"
        )
        .repartitionByRange(64, "event_id")
        .sortWithinPartitions("event_id")
        .write.parquet(f"{out}/events.parquet")
    )
    return out


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tidemark-bench")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    prepare(spark)
    registered = catalog.queries()
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else HEADLINE
    # Start the JVM's code paths before the clock runs.
    timed(lambda: registered["snapshot_counts"](spark, sf_dir))
    seconds = {n: timed(lambda n=n: registered[n](spark, sf_dir)) for n in names}
    line = {
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": float(re.sub(r".*sf", "", sf_dir.rstrip("/"))),
    }
    repeat = int(os.environ.get("BENCH_COPIES", "0"))
    if repeat:
        big = copies(spark, sf_dir, repeat)
        line["copies"] = repeat
        line["queries_on_copies"] = {
            n: timed(lambda n=n: registered[n](spark, big)) for n in names if n in ON_LOG
        }
    print(json.dumps(line))


if __name__ == "__main__":
    main()
