"""Time the headline queries and print one JSON line.

Reads ``BENCH_SF_DIR`` (default sf0.1) and ``BENCH_CPUS``. Each query is built and its
whole result computed into Spark's no-op sink; the better of two runs counts.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from checks.queries import QUERIES  # noqa: E402

HEADLINE = [
    "ngd_flatfile",
    "abp_flatfile",
    "enrich_addresses",
    "dedup_priority",
    "lpi_base",
    "business_historical",
    "combine_and_dedupe",
    "best_delivery_point",
    "best_classification",
    "split_records_lpi",
    "split_records_counts",
    "normalise_address",
    "variant_statistics",
    "top_keys",
]
RUNS = 2


def run(spark: SparkSession, sf_dir: str, name: str) -> float:
    started = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {name: round(min(run(spark, sf_dir, name) for _ in range(RUNS)), 3) for name in HEADLINE}
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": Path(sf_dir).name.removeprefix("sf"),
                "cpus": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()
