"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS (default 8) the cores.
Each query runs once on the smallest tables beside the timed ones, to start the JVM, the compiler
and the Python workers, and is then timed once over its whole tables, results included.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from checks.spark_queries import QUERIES  # noqa: E402

HEADLINE = [
    "q01_parse_delimited", "q03_numeric_features", "q05_last_field_counts", "q07_one_hot_assemble",
    "q11_vector_stats", "q12_zscore", "q14_covariance", "q15_pca_project", "q17_lloyd_centers",
    "q21_cluster_label_counts", "q23_k_sweep", "q24_weighted_entropy", "q25_default_job",
    "q26_restarts_score", "q27_pca_entropy_job", "q28_normalised_sweep", "q29_categorical_sweep",
    "q31_anomalies", "q32_anomalies_fixed_k", "q33_top10_anomalies", "q34_pca_anomalies",
    "q41_stream_kmeans", "q43_stream_cluster_label", "q46_stream_raw_sweep", "q48_stream_anomalies",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    warm_dir = os.path.join(os.path.dirname(sf_dir), "sf0.001")
    chosen = sys.argv[1:] or HEADLINE
    seconds = {}
    for name in chosen:
        if os.path.isdir(warm_dir):
            QUERIES[name](spark, warm_dir).write.format("noop").mode("overwrite").save()
        started = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
    print(json.dumps({
        "metric": "headline queries, total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
