"""Time the headline queries and print one JSON line.

Environment: BENCH_SF_DIR (tables), BENCH_CPUS (local cores), BENCH_QUERIES
(comma-separated names, or "all"), BENCH_RUNS (timed runs after one warm-up).
"""

import json
import os
import statistics
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession  # noqa: E402

from stratalens.catalog import load  # noqa: E402

HEADLINE = (
    "ordinal_moments moments_null_all timepoints_wide collapse_7_to_3 validity_flags performance_score "
    "emd_segments segment_deltas yoy_inner chain_segments_3level chain_progress exclusion_reason "
    "percentile_rank percentile_rank_lines quantile_summary priority_ranking composite_ranking "
    "weight_sensitivity reference_table pairwise_wide fuzzy_match match_split fuzzy_match_blocks exact_cascade name_normalise reconcile "
    "partition_overwrite"
).split()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    registry = load()
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(registry) if chosen == "all" else [n for n in chosen.split(",") if n] or HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.checkpoint.dir", os.environ.get("BENCH_SHARED_DIR") or tempfile.mkdtemp(prefix="bench-shared-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        spent = []
        for _ in range(runs + 1):
            begin = time.perf_counter()
            registry[name].run(spark, folder).write.format("noop").mode("overwrite").save()
            spent.append(time.perf_counter() - begin)
        seconds[name] = round(statistics.median(spent[1:]), 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "headline queries, median of timed runs, total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": Path(folder).name.removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
