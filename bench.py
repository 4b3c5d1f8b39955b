"""Benchmark the headline queries.

Runs each query once to warm up the JVM, then three times, and reports the
median wall-clock per query.  A run plans the query anew, lists its files
again and uses no cached data: the library keeps no state between runs.
Every run executes the whole plan through the
``noop`` sink, so nothing is collected to the driver.  Prints one JSON line.

env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
     BENCH_QUERIES (comma list, default the headline set), BENCH_RUNS (3).
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cohortkit.plans.catalog import QUERIES  # noqa: E402
from cohortkit.session import get_session  # noqa: E402

HEADLINE = [
    # the reference's scripted analytics (scripts 04-07, 09-10)
    "join_hit_rate", "median_by_level", "category_share", "topk_tags", "tag_set_share",
    "flag_rate", "topk_region", "series_code_decode", "series_select", "series_pivot",
    # profiling, cleaning and bridge (scripts 01-03)
    "profile_long", "clean_audit", "top_values", "numeric_summary", "dedup_pairs", "csv_multiline_roundtrip",
    # row-heavy outputs (every fact or bridge row reaches the sink)
    "cohort_tag", "lookup_left_join", "alias_dictionary",
    # joins with skew-prone keys
    "semi_join_count", "orphan_tags", "unmatched_top", "recency_cohort", "null_aware_rate",
    # heavier derived operators
    "median_exact", "topk_rank_compare", "bootstrap_rate", "bootstrap_median_baseline", "bootstrap_median", "fuzzy_key_match", "integrity_checks",
    # one pass with the write, stored summaries, co-located and prefiltered joins
    "clean_write_audit", "frequent_values", "distinct_sketch_merge", "median_sketch_merge", "topk_tags_bucketed", "cohort_tag_prefiltered",
    "row_sample", "series_missing_months",
]


def run_once(spark, fn, base) -> float:
    spark.catalog.clearCache()  # nothing kept by an earlier run is used
    t0 = time.perf_counter()
    fn(spark, base).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    base = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    driver_mem = os.environ.get("BENCH_DRIVER_MEMORY", "8g")
    spark = get_session(f"local[{cpus}]", shuffle_partitions=2 * cpus, app_name="cohortkit-bench",
                        extra={"spark.driver.memory": driver_mem})
    results = {}
    for name in names:
        fn = QUERIES[name]
        run_once(spark, fn, base)  # warm-up
        results[name] = round(statistics.median(run_once(spark, fn, base) for _ in range(runs)), 3)
    m = re.search(r"sf([0-9.]+)", base)
    print(json.dumps({
        "metric": "sum_of_median_query_seconds",
        "value": round(sum(results.values()), 3),
        "unit": "sec",
        "queries": results,
        "sf": float(m.group(1)) if m else None,
        "cpus": cpus,
        "driver_memory": driver_mem,
        "spark": spark.version,
        "runs": runs,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
