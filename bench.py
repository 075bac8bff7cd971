"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the number of local threads.
"""

import json
import os
import re
import time

from pyspark.sql import SparkSession

from paceline.queries import all_queries

HEADLINE = [
    "form_roll3", "career_expanding", "keyed_expanding", "line_history", "dense_scaled", "asof_last", "asof_batch",
    "rank_delta", "group_corr_guarded", "circuit_importance", "median_fill", "name_codes", "lap_features",
    "stint_pivot", "compound_changes", "timing_rows", "race_features", "sprint_features", "season_replace",
    "season_sink", "json_qualifying", "entity_keys", "metrics_mode", "rf_two_stage",
]


def main():
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = all_queries()
    spark.read.parquet(f"{folder}/region.parquet").groupBy("r_name").count().collect()  # start the JVM's work
    seconds = {}
    for name in names:
        start = time.perf_counter()
        queries[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    scale = re.search(r"sf([\d.]+)", folder)
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else None,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
