"""Time the headline queries and print one JSON line.

`BENCH_SF_DIR` names the tables, `BENCH_CPUS` the local cores, `BENCH_RUNS` the
timed runs per query after one warm-up (the median counts).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

from ledgerstrata.plans.registry import QUERIES

HEADLINE = [
    "transactions_classified",
    "transactions_classified_lineitem",
    "gold_daily_summary",
    "gold_daily_summary_lineitem",
    "gold_weekly_account_summary",
    "gold_weekly_account_summary_lineitem",
    "silver_accounts",
    "rejection_summary",
    "reconciliation",
    "bronze_transactions",
    "run_log_latest",
    "check_all",
    "historical_run",
]
# Whole runs write files and take long enough without a warm-up.
ONCE = {"check_all", "historical_run"}


def timed(spark: SparkSession, name: str, sf_dir: str) -> float:
    started = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("ledgerstrata-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        if name in ONCE:
            samples = [timed(spark, name, sf_dir)]
        else:
            timed(spark, name, sf_dir)
            samples = [timed(spark, name, sf_dir) for _ in range(runs)]
        seconds[name] = round(statistics.median(samples), 3)
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()
