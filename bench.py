"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data
and cores. Every query starts from the raw tables: written stages are forgotten
before each one. Names given as arguments replace the default list. BENCH_RUNS (default 1)
repeats every query and reports the median.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

from opsignal.plans import catalogue, corpus

HEADLINE = (
    "q_a4_score_all_signals",
    "q_n12_normalise_signals",
    "q_a5_anomaly_summary",
    "q_m2_stratified_split",
    "q_j7_time_window_pairs",
    "q_k9_top_tokens",
    "q_f6_similarity_tfidf",
    "q_j13_top_k_similar",
    "q_m7_training_run",
    "q_c10_correlate_signals",
    "q_e5_correlation_evaluation",
    "q_j5_sparse_cosine_join",
    "q_x3_stream_top_k",
    "q_x6_stream_edges",
    "q_c10_dense_correlation",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/events.parquet").groupBy("event_type").count().collect()
    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        runs = []
        for _ in range(int(os.environ.get("BENCH_RUNS", "1"))):
            corpus.forget()
            start = time.time()
            catalogue.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.time() - start)
        seconds[name] = round(statistics.median(runs), 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "headline queries, total seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
