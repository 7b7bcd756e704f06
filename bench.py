"""Headline queries at one scale: one warm-up and the median of three runs each; whole jobs once.

Prints one JSON line.  ``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the threads.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

HEADLINE = (
    "release_summary",
    "file_list_distinct",
    "absolute_paths",
    "map_datastores",
    "map_datastores_by_table",
    "glob_types",
    "flatten_chain",
    "search_find_first",
    "search_all_calib",
    "find_first_events",
    "datastore_lookup",
    "assoc_filter",
    "remove_value",
    "prune_exposure",
    "prune_visit",
    "prune_member",
    "prune_definition",
    "transfer_skip",
    "transfer_totals",
    "transfer_running_total",
    "duplicate_ids",
    "orphans",
    "load_by_run",
    "assoc_by_collection",
    "progress_fold",
    "count_report",
)

# Whole jobs, each from the tables: export, its prune, removal, plan, load and summary.  Timed once, without a warm-up.
PRODUCTS = (
    "export_datasets",
    "pruned_release",
    "transfer_plan",
    "loaded_release",
    "summarize_subset",
    "provenance_pass",
)


def main() -> None:
    from releasecat.registry import QUERIES
    from releasecat.session import build_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE + PRODUCTS
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "8g"),
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        times = []
        for _ in range(1 if name in PRODUCTS else runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:] or times), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(v for k, v in seconds.items() if k not in PRODUCTS), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
