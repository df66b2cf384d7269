"""Time the headline queries and print one JSON line.

Each query runs once to warm up and three times more; the median of the three is reported. The
result of a query is computed in full and thrown away by Spark's ``noop`` sink.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from harness.registry import QUERIES
from millrace.session import local_session

HEADLINE = [
    "conform_scalar",
    "conform_nested",
    "key_hour",
    "view_projection",
    "view_recent",
    "view_returns_pending",
    "land_sales_retail",
    "land_omniture_logs",
    "land_mobile_events",
    "write_hour",
    "write_month",
    "write_day",
    "write_cluster",
    "write_cluster_two",
    "read_pruned",
    "cleansed_orders",
    "cleansed_customers",
    "cleansed_products",
    "geocoded_addresses",
    "dedup_clickstream",
    "parsed_events",
    "merged_cdc",
    "merged_cdc_in_steps",
    "carrier_events",
    "fraud_scored",
    "kpi_snapshot",
    "check_casts",
    "check_parity",
    "check_differences",
]
RUNS = 3


def seconds(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores, shuffle_partitions=int(cores), memory="16g")
    timings = {}
    for name in HEADLINE:
        seconds(spark, name, sf_dir)
        timings[name] = round(statistics.median(seconds(spark, name, sf_dir) for _ in range(RUNS)), 3)
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
        "cores": int(cores),
        "spark": spark.version,
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
