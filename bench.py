"""Headline timings: one warm-up, then the median of three runs into a noop sink."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

from stocktrail.plans.queries import QUERIES
from stocktrail.runtime import remove_work

# Query and number of timed runs.
HEADLINE = {
    "allocate_layers_newest_first": 3,
    "stock_on_hand": 3,
    "collapse_repeated_lines": 3,
    "alternative_link_join": 3,
    "running_inventory": 3,
    "receipt_number": 3,
    "fill_within_group": 3,
    "sales_order_balance": 1,
    "stock_origin_report": 1,
}


def session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("stocktrail-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def timed(spark: SparkSession, name: str, folder: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = session(cpus)
    times = {}
    for name, runs in HEADLINE.items():
        timed(spark, name, folder)
        times[name] = round(statistics.median(timed(spark, name, folder) for _ in range(runs)), 3)
        remove_work(spark)
        print(name, times[name], file=sys.stderr)
    out = {
        "metric": "headline_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
        "spark": spark.version,
        "cpus": int(cpus),
    }
    print(json.dumps(out))


if __name__ == "__main__":
    main()
