"""Time the headline queries: one warm-up, then the median of three runs each, and the long ones once; prints
one JSON line."""

import json
import os
import statistics
import time

from pyspark.sql import SparkSession

from wardbook.plans.queries import all_queries

HEADLINE = [
    "s3_clean_ident",
    "r2_profile_pivot",
    "p1_stg_crime",
    "p2_stg_ttc_delays",
    "p5b_bad_values",
    "j1_dim_neighbourhood",
    "j2_fct_ttc_delays",
    "j9_star_crime",
    "a1_crime_monthly",
    "a2_ttc_station_month",
    "a3_hourly_delays",
    "a8_having_duplicates",
    "q2_unique",
    "q4_relationships",
    "q6_unique_combination",
    "m1_grid",
    "m2_features",
    "w2_prev_24h",
    "m9_pr_auc",
    "b3_rate",
    "b4_yoy",
    "b7_top_neighbourhoods",
    "b12_yearly_rates",
    "b14_top_station",
    "b16_top_station_months",
    "x1_snapshot_diff",
    "x2_latest_by_key",
]
RUNS = 3
# Whole stages of a run: the data tests, and landing, models, tests and training of three models.
LONG = ["q10_run_checks", "s18_run_all"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("wardbook-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries, seconds = all_queries(), {}
    for name in HEADLINE + LONG:
        times = []
        for _ in range(1 if name in LONG else RUNS + 1):
            start = time.perf_counter()
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:] or times), 3)
    total = round(sum(seconds.values()), 3)
    sf = sf_dir.rstrip("/").rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": seconds, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
