"""Headline timings. Prints one JSON line.

Reports R1..R5 read the written warehouse, as users do; ``etl_end_to_end`` runs from the landed raw trips to a
validated warehouse. Every figure is the median of three warm runs, results fetched.
"""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time

from pyspark.sql import SparkSession

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = 3
HEADLINES = (
    "q1_revenue_by_period",
    "q2_tip_by_distance",
    "q3_hourly_demand",
    "q4_top_zones",
    "q5_airport_trend",
    "q5_iso_week",
    "vendor_revenue",
    "q_median",
    "dq_findings",
    "etl_end_to_end",
)


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("tripmart-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", CPUS)
        # the test files hold one row group each; several small output files let later scans use every core
        .config("spark.sql.files.maxRecordsPerFile", "80000")
        # no call-site capture for every column expression
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tripmart-bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    from tripmart.catalog import stage
    from tripmart.catalog.queries import QUERIES

    start = time.perf_counter()
    rows = stage.raw_trips(spark, SF_DIR).count()
    landing = time.perf_counter() - start
    stage.warehouse(spark, SF_DIR)

    seconds = {}
    for name in HEADLINES:
        QUERIES[name](spark, SF_DIR).collect()
        times = []
        for _ in range(RUNS):
            start = time.perf_counter()
            QUERIES[name](spark, SF_DIR).collect()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times), 3)
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "trips": rows,
                "landing_cold_sec": round(landing, 3),
                "etl_rows_per_sec": round(rows / seconds["etl_end_to_end"]),
                "cpus": CPUS,
                "driver_memory": "8g",
                "spark": spark.version,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
