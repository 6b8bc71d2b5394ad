"""Time the headline queries on one data folder; prints one JSON line.

BENCH_SF_DIR: data folder; BENCH_CPUS: local threads; BENCH_RUNS: timed runs per query after
one warm-up run. The median run of each query counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from stockloom.queries import registry  # noqa: E402

HEADLINE = [
    "v_category_sales", "v_low_stock_alerts", "v_order_fulfillment_kpis",
    "v_inventory_value_by_location", "r01_top_products", "r10_supplier_performance",
    "r13_fast_movers", "r14_slow_movers", "r15_inventory_turnover", "r16_customer_frequency",
    "r18_top_customers", "r20_shipping_delays", "k_summary", "m_staff_cards", "pick_list",
    "op_default_price", "op_ledger_from_orders", "op_reserve", "op_put_away", "op_ship_ledger",
    "op_return_ledger", "op_move_stock", "op_receive", "op_complete_pick_ledger",
    "check_constraints", "order_lookup", "op_occupancy_stream",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("stockloom-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    spark = builder.getOrCreate()
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="stockloom-bench-"))
    spark.sparkContext.setLogLevel("ERROR")

    queries = registry()
    seconds = {}
    for name in HEADLINE:
        times = []
        for _ in range(1 + runs):
            start = time.perf_counter()
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:]), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total time of the headline queries, warm",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
