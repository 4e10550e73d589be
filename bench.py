"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default all) set data and threads. The stand-in
tables are written before the clock of the queries starts; that time is reported as ``stage_tables``. Each query
runs once unmeasured for JVM warm-up and then BENCH_RUNS times (default 1), of which the best counts.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession  # noqa: E402

from mailtax.plans.queries import all_queries  # noqa: E402
from mailtax.plans.session import configure  # noqa: E402
from mailtax.sources.standins import standin_tables  # noqa: E402

HEADLINE = [
    "rate_distribution",
    "rate_distribution_line_bridge",
    "sales_tax_details",
    "taxable_line_items",
    "non_service_line_items",
    "session_line_item_batches",
    "infer_host_system",
    "qualify_details",
    "reconcile_quantity",
    "generate_delivery_points",
    "link_details_to_transactions",
    "invoice_warnings",
    "category_totals",
    "return_update_counts",
    "line_item_batches_by_module",
    "active_clients",
    "parse_log_lines",
    "sales_tax_run",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "*")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    wanted = sys.argv[1:] or HEADLINE
    cores = os.cpu_count() if cpus == "*" else int(cpus)
    spark = (
        configure(SparkSession.builder.master(f"local[{cpus}]").appName("bench"))
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(cores))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = all_queries()

    def run(name: str) -> float:
        start = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    start = time.perf_counter()
    tables = standin_tables(spark, sf_dir)
    for name in tables:
        tables[name]
    times = {"stage_tables": time.perf_counter() - start}
    for name in wanted:
        run(name)
        times[name] = min(run(name) for _ in range(runs))
    spark.stop()
    times = {k: round(v, 3) for k, v in times.items()}
    total = round(sum(v for k, v in times.items() if k != "stage_tables"), 3)
    print(json.dumps({"metric": "total_query_time", "value": total, "unit": "sec", "queries": times,
                      "sf": Path(sf_dir).name.removeprefix("sf")}))


if __name__ == "__main__":
    main()
