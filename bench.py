"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS (default 8) the cores,
BENCH_QUERIES a comma-separated choice of queries. Every query runs once to warm up; its figure
is the median of the warm runs that follow, three for short ones and one for long ones.
"""

import json
import os
import statistics
import sys
import time

from strata.queries import QUERIES
from strata.session import build_session

HEADLINE = [
    "word_count_batch", "word_count_files", "word_count_stream", "trade_window", "trade_window_stream",
    "invoice_line_items", "envelope_decode", "week_part_partitions", "latest_change", "age_bins", "rewards",
    "interval_pairs", "interval_pairs_stream", "contained_points", "contained_points_stream", "presence",
    "session_stats", "session_stats_stream", "dedup_stream", "merge_insert_only", "merge_update_all",
    "merge_if_newer", "rewards_replace_stream", "rewards_additive_stream", "ingest_by_position",
    "invoice_layers", "gym_layers",
]
LONG = 5.0  # seconds from which one warm run has to do


def timed(run, spark, folder):
    started = time.perf_counter()
    run(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main():
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    spark = build_session("bench", f"local[{cpus}]", {"spark.ui.enabled": "false", "spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    took = {}
    for name in chosen:
        first = timed(QUERIES[name], spark, folder)
        runs = [timed(QUERIES[name], spark, folder) for _ in range(1 if first > LONG else 3)]
        took[name] = round(statistics.median(runs), 3)
        print(name, took[name], file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "headline queries, sum of warm medians", "value": round(sum(took.values()), 3), "unit": "sec",
        "queries": took, "sf": folder.rsplit("/sf", 1)[-1],
    }))


main()
