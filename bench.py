"""Headline queries, timed: one JSON line.

Settings: BENCH_SF_DIR (tables), BENCH_CPUS (threads), BENCH_RUNS (timed runs; the median
counts). Every query is run once before it is timed.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from millrace.queries import QUERIES
from millrace.session import local_session

HEADLINE = [
    "job_id_from_url", "key_stats", "null_profile", "summary_row_filter", "impute_median", "impute_mode",
    "impute_per_source", "median_per_source", "mode_per_source", "numeric_coercion", "datetime_coercion",
    "dedup_rows", "merge_outer", "merge_inner", "merge_outer_3way", "merge_outer_groupby",
    "merge_outer_hot_key", "merge_outer_repeats", "concat_files", "master_report", "assess_text",
    "csv_scan", "quality_report", "clean_exports", "master_outer",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(cores, "millrace-bench")
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in sys.argv[1:] or HEADLINE:
        taken = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        times[name] = round(statistics.median(taken[1:]), 3)
    print(json.dumps({
        "metric": "headline queries, total of medians",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
