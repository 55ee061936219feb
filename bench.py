"""Time the headline queries; one JSON line on standard output.

BENCH_SF_DIR names the tables, BENCH_CPUS the threads. Every query computes all its rows and
columns into a sink that discards them.
"""

from __future__ import annotations

import json
import os
import time

from botiquin.plans.registered import QUERIES
from botiquin.session import build

HEADLINES = (
    "board_core", "board_full", "board_legacy", "board_page", "board_kpis", "critical_items",
    "consumption_top10", "level_distribution", "pending_delivery_by_item",
    "dedupe_latest", "dedupe_orders", "dedupe_by_date", "dedupe_complete", "dup_audit",
    "orders_kpis", "execution_top100", "coerce_numbers", "coerce_dates", "format_numbers",
    "sanitize_text", "load_orders", "load_execution", "csv_round_trip", "upsert_edits",
    "changed_rows", "incremental_delta", "incremental_stream", "sync_verify", "quality_report",
    "table_counts",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.driver.memory": "12g",
            "spark.driver.host": "127.0.0.1",
            "spark.driver.bindAddress": "127.0.0.1",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    # Each query runs twice: the first run pays for code generation and class loading, the second
    # is the figure.
    first, seconds = {}, {}
    for name in HEADLINES:
        for figures in (first, seconds):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            figures[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "first_run": first,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
