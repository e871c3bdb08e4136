"""Time the headline queries and print one JSON line.

BENCH_SF_DIR   folder of Parquet tables (default /root/testdata/sf0.1)
BENCH_CPUS     cores of the local master (default 8)
BENCH_QUERIES  comma-separated names, or "all" (default: the headline list)

Each query runs once to warm up and then three times; the median counts. The
whole result is computed (no-op sink), nothing is collected.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from millrace.plans import all_jobs
from millrace.session import local_session

HEADLINE = [
    "rooms_student_count",
    "smallest_avg_age_5",
    "largest_age_dif_5",
    "dif_sex_rooms",
    "count_distinct_by_category",
    "top10_with_ties",
    "top1_with_ties",
    "anti_not_exists",
    "dense_rank_top3",
    "active_inactive_by_city",
    "max_rental_hours_by_city",
    "sales_by_category",
    "sales_by_store",
    "customer_balance",
    "rewards_report",
    "view_actor_info",
    "group_describe",
    "group_value_share",
    "group_filter",
    "distribution_summary",
    "first_percentile_above",
    "max_after_zero",
    "run_length_encode",
    "pairwise_euclidean",
    "clean_text",
    "top5_frequent",
    "avg_per_day",
    "sink_upsert_by_key",
    "stream_upsert",
    "text_index",
]


def seconds(run) -> float:
    start = time.perf_counter()
    run().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    chosen = os.environ.get("BENCH_QUERIES", "")
    jobs = all_jobs()
    names = list(jobs) if chosen == "all" else chosen.split(",") if chosen else HEADLINE
    spark = local_session(cpus, "millrace-bench")
    times = {}
    for name in names:
        run = lambda: jobs[name].run(spark, folder)  # noqa: B023
        seconds(run)
        times[name] = round(statistics.median(seconds(run) for _ in range(runs)), 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    result = {
        "metric": "total seconds of the headline queries (median of warm runs)",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }
    spark.stop()
    print(json.dumps(result))


if __name__ == "__main__":
    main()
