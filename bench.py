"""Times the registered headline queries and prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8) and, to pick
queries, BENCH_QUERIES (comma separated, 'all' for every registered one).
"""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks import all_queries  # noqa: E402
from waymend.session import build_session  # noqa: E402

HEADLINE = [
    "audit_row_flags", "audit_ordered_flags", "seq_discontinuity", "dup_exact", "dup_seq", "dup_stop",
    "audit_flag_counts", "validate_stops", "quality_score", "normalize_names", "similarity",
    "station_crossref", "enrich", "split_row_repair", "adjacent_duplicates", "code_suggestion",
    "cross_fill", "overlap_resolution", "merge_sources", "old_schedule", "new_schedule",
    "resolve_names", "schedule_status", "import_rows", "gated_replace", "segment_median",
    "chain_fill", "move_rows",
]


def main():
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    picked = os.environ.get("BENCH_QUERIES", "")
    queries = all_queries()
    names = list(queries) if picked == "all" else [n for n in picked.split(",") if n] or HEADLINE
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "20g",
            # Small data on one machine: keep all cores busy after a shuffle.
            "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{folder}/lineitem.parquet").write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        begin = time.perf_counter()
        queries[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - begin, 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")),
                "cpus": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()
