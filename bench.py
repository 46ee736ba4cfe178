"""Benchmark: headline queries and whole runs on local[BENCH_CPUS], one JSON line."""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemark.plans import catalog  # noqa: E402
from tidemark.plans.batch import BatchConfig, run_batch  # noqa: E402
from tidemark.sources import adapter  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
HEADLINE = [
    "observe_params", "classify_name", "identity_map", "page_view_id", "event_sequence",
    "domain_hops", "dedup_events", "event_table", "assemble_events", "fold_scroll", "fill_slots",
    "micro_user", "explode_items", "number_items", "micro_items", "user_attributes",
    "user_property_log", "range_replace", "upsert_by_key", "update_from",
]


def timed(action) -> float:
    began = time.perf_counter()
    action()
    return round(time.perf_counter() - began, 3)


def drain(frame) -> None:
    frame.write.format("noop").mode("overwrite").save()


def whole_runs(spark: SparkSession) -> dict[str, float]:
    """A full build of 29 days from stored nested events, then the 30th day on top."""
    root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    events = adapter.web_events(spark, SF_DIR, adapter.RICH_NAMES).drop("source_id")
    events.repartition("shard").write.partitionBy("shard").parquet(f"{root}/events")
    users = adapter.customer_snapshots(spark, SF_DIR)
    users.write.partitionBy("shard").parquet(f"{root}/users")

    def run(start: str, end: str, incremental: bool) -> None:
        cfg = BatchConfig(
            start, end, f"{root}/events", f"{root}/out", f"{root}/users", incremental=incremental
        )
        row = run_batch(spark, cfg).first()
        states = [row[f"phase_{p}_status"] for p in ("0", "1", "2", "3a", "3b")]
        if not all(s.startswith(("SUCCESS", "PARTIAL")) for s in states):
            raise RuntimeError(f"run failed: {states}")

    return {
        "run_full_29_days": timed(lambda: run("20240101", "20240129", False)),
        "run_incremental_day": timed(lambda: run("20240130", "20240130", True)),
    }


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("tidemark-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.files.minPartitionNum", CPUS)
        .config("spark.sql.files.openCostInBytes", "65536")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    drain(adapter.web_events(spark, SF_DIR).groupBy("event_name").agg(F.count("*")))
    times = {}
    for name in HEADLINE:
        times[name] = timed(lambda: drain(catalog.QUERIES[name](spark, SF_DIR)))
    times |= whole_runs(spark)
    print(
        json.dumps(
            {
                "metric": "event flattening, headline queries and runs",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
