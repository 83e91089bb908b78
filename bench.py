"""Time the headline queries and print one JSON line.

BENCH_SF_DIR: table folder (default /root/testdata/sf0.1). BENCH_CPUS: local
cores (default 8). BENCH_RUNS: timed runs per query after one warm-up (default
1; the median counts). BENCH_QUERIES: comma list instead of the headline ones.
"""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time

from shelfline.catalog.queries import QUERIES
from shelfline.session import build_session

HEADLINE = (
    "business_pulse", "business_pulse_full", "sales_filtered_union", "alcohol_sales_detail",
    "sales_rollup_12key", "business_plan_rollup", "daily_sales", "daily_sales_by_sku",
    "pos_weekly_with_periods", "pos_weekly_report", "equipment_recode", "customer_route_report",
    "clean_transactions", "visit_sovi_store", "visit_photo", "usage_long", "hr_master", "activity_events",
    "row_slices", "two_day_reload",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or list(HEADLINE)
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "16g",
        "spark.ui.showConsoleProgress": "false",
        # The lines come as one file of one row group, which no scan can split. Their join with the orders
        # spreads them over the cores if it shuffles; masters stay below this size.
        "spark.sql.autoBroadcastJoinThreshold": "1m",
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="shelfline-bench-")})
    spark.sparkContext.setLogLevel("ERROR")

    def once(name: str) -> float:
        start = time.perf_counter()
        # Every row and column is computed, none is kept.
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {}
    for name in names:
        once(name)
        seconds[name] = round(statistics.median(once(name) for _ in range(runs)), 3)
    spark.stop()
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
