"""Time the headline queries; prints one JSON line.

Every query runs once to warm up and then ``BENCH_RUNS`` times (default 2); the best
run counts. A run includes building the plan and computing all rows.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

import checks  # noqa: E402
from hanok.session import build_session  # noqa: E402

HEADLINE = (
    "region_monthly_stats",
    "complex_monthly_median",
    "region_last12m",
    "complex_bucket_12m",
    "national_monthly_price",
    "region_decision_monthly",
    "region_decision_latest",
    "national_signal_trend",
    "complex_premium_latest",
    "complex_gap_12m",
    "monthly_trades",
    "trade_listing",
    "price_change",
    "price_change_frames",
    "map_layer",
    "top_bottom",
    "avg_price_by_date",
    "clean_trades",
    "page_changes",
    "completeness_audit",
    "crawl_worklist",
    "lineage_edges",
)


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    wanted = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark_sql_shuffle_partitions=cpus,
        spark_driver_memory="16g",
        spark_ui_showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in wanted:
        best = None
        for run in range(runs + 1):
            start = time.perf_counter()
            checks.QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - start
            if run:
                best = took if best is None else min(best, took)
        times[name] = round(best, 3)
    spark.stop()
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": sf}))


if __name__ == "__main__":
    main()
