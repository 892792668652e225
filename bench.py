"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR names the data folder, BENCH_CPUS the local cores, BENCH_RUNS
the timed runs per query, of which the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from odflux.settings import settings_for
from workload.queries import QUERIES

HEADLINE = (
    "combine_series",
    "recode_sum",
    "recode_both_ends",
    "unpivot_age",
    "gross_flows",
    "aggregate_to_region",
    "od_by_geography",
    "final_gross_flows",
    "all_od_flows",
    "children_net_flows",
    "children_net_wide",
    "net_flows",
    "changed_codes",
    "partitioned_sink",
    "first_link_per_year",
)


def session(cpus: str, sf_dir: str) -> SparkSession:
    input_bytes = sum(file.stat().st_size for file in Path(sf_dir).glob("*.parquet"))
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("flow-series-bench")
        .config(map=settings_for(input_bytes, int(cpus)))
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
    )
    builder = builder.config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="run-"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = session(os.environ.get("BENCH_CPUS", "8"), sf_dir)
    run(QUERIES["gross_flows"](spark, sf_dir))
    seconds = {}
    for name in HEADLINE:
        times = []
        for _ in range(runs):
            start = time.perf_counter()
            run(QUERIES[name](spark, sf_dir))
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times), 3)
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
