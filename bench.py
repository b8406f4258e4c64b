"""Time the headline queries: prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from trajspark.plans import load

# One per family of operators, each over its whole tables.
HEADLINE = (
    "W1_J1_training_window",
    "W9_next_state",
    "W13_latched_reference",
    "W16_resample",
    "S4_small_episode_stats",
    "S9_dataset_stats_axis_0",
    "S11_eval_summary",
    "N1_normalize_min_max",
    "D1_delete_episodes",
    "D3_merge",
    "K1_pack_files",
    "P1_progress_weights",
    "J5_nearest_frame",
    "J6_dedupe_catalog",
    "F9_tokenize",
    "A1_A5_write_and_read",
    "T1_stream_delta_window",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("trajspark-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries, _ = load()
    spark.read.parquet(f"{sf_dir}/events.parquet").groupBy("event_type").count().collect()  # start the JVM's workers
    times = {}
    for name in HEADLINE:
        start = time.time()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - start, 3)
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": times, "sf": os.path.basename(sf_dir)}))


if __name__ == "__main__":
    main()
