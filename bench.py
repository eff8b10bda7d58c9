"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` is the input (default sf0.1), ``BENCH_CPUS`` the local cores.
Each query runs once to warm up and then three times; the median counts. Results
go to the ``noop`` sink, so every row is computed and none is collected.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession

from checks.catalog import QUERIES
from ordergate.session import configure

HEADLINE = (
    "v_sla_daily", "v_sla_by_restaurant", "v_sla_by_driver", "v_sla_by_region", "v_revenue_impact",
    "v_reopen_rate", "sla_summary_day", "top_refund_restaurants", "worst_drivers", "sla_flags",
    "dedup_keep_first", "dedup_stats", "validation_stats", "valid_rows", "fk_valid_orders",
    "fk_orphan_orders", "fk_cascade_label", "orphan_stats", "pii_mask_customers", "warehouse_cast",
    "upsert_merge", "upsert_partial_columns", "quality_log_rows", "json_scan", "csv_scan",
)
# Whole jobs, dominated by fixed cost at small sizes: one run each, after the fixture exists.
JOBS = ("batch_job_customers", "stream_job_orders")


def timed(spark: SparkSession, name: str, sf_dir: str) -> float:
    started = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        configure(SparkSession.builder.master(f"local[{cpus}]").appName("bench"))
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        timed(spark, name, sf_dir)
        seconds[name] = round(statistics.median(timed(spark, name, sf_dir) for _ in range(3)), 3)
    for name in JOBS:
        timed(spark, name, sf_dir)
        seconds[name] = round(timed(spark, name, sf_dir), 3)
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
