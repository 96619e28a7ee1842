"""Time the headline queries: one JSON line on stdout.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and cores.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from fieldguard.plans import catalog

HEADLINE = (
    "e1_extract",
    "r2_range_iqr",
    "r3_range_mad",
    "r4_range_cover",
    "r15_learn",
    "t1_field_audit",
    "t1_learn_and_audit",
    "t10_model_pass_rate",
    "t11_scorecard",
    "t13_both_variants",
    "d1_flatten",
    "d9_presence",
    "w1_episode_dim",
    "w7_fact",
    "x6_field_data",
    "x8_sample",
    "x11_index",
    "x13_numeric_stats",
    "p2_update",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("fieldguard-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    # The first run of a query also pays for compiling it; the second is the one reported.
    times: dict[str, float] = {}
    for name in HEADLINE:
        run(name)
        times[name] = round(run(name), 3)
    sf = os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "total of headline queries, warm",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
