"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the local cores.
"""

from __future__ import annotations

import json
import os
import time

from tidewater.plans import QUERIES
from tidewater.session import build_session

HEADLINE = [
    "scan_parquet",
    "rescue_json",
    "split_valid",
    "dedup_full_row",
    "merge_upsert",
    "merge_composite_key",
    "batch_error_rate",
    "batch_metrics",
    "late_rows",
    "violation_report",
    "iot_daily_rollup",
    "weather_daily_rollup",
    "sales_fact_d1",
    "inventory_fact_d1",
    "sales_star",
    "circuit_breaker_states",
    "alert_masking",
    "ttl_purge",
    "ingest_iot",
    "ingest_weather",
    "ingest_sales",
    "ingest_inventory",
    "stream_dedup",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        f"local[{cpus}]",
        "tidewater-bench",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="12g",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    # The first job of a session pays for starting it.
    spark.read.parquet(f"{sf_dir}/events.parquet").groupBy("event_type").count().write.format("noop").mode("overwrite").save()
    times = {}
    for name in HEADLINE:
        started = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - started, 3)
    total = round(sum(times.values()), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
