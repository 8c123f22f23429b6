"""Headline queries, timed: prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (default 3 warm runs; their median counts).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from quern.plans import QUERIES  # noqa: E402

HEADLINE = [
    "b03_describe_numeric", "b07_box_two_keys", "b09_density",
    "c04_not_equal_keeps_missing", "c08_membership",
    "d01_inner_join_distinct", "d06_points_in_intervals", "d11_nearest_item",
    "e02_means_two_keys", "e05_two_level_totals", "e10_distinct_per_day", "e11_sum_of_product",
    "f05_cumulative_sum", "f07_merge_intervals", "f08_max_concurrent", "f09_run_lengths", "f16_shortest_run",
    "f17_longest_without_repeat", "f24_trailing_count", "g02_top_products",
    "h01_reverse_words", "i04_product", "i07_covariance",
    "l07_order_value_by_category", "l10_most_enterprise_customers", "l12_monthly_growth", "l16_rank_in_country",
    "l18_product_month_over_month", "l23_top_three_per_category", "l24_ordered_in_every_region", "l27_category_share_by_region",
    "l29_funnel", "m01_term_vectors", "m06_rubric_score", "n07_verdict", "o01_one_feature",
    # the dear ones
    "a05_json_accepted", "d12_one_letter_neighbours", "e15_anagrams", "f14_circular_next", "f18_longest_with_two", "f27_reuse_distance",
    "i02_most_similar", "j01_shortest_paths", "j02_topological_levels", "j04_letter_order", "j07_task_levels",
    "k01_streaming_trailing_count", "k02_streaming_top", "m04_near_duplicates", "m05_greedy_dedup", "m09_audit_trail",
    "m10_stage_funnel", "o02_many_features", "o05_ridge",
]


#: queries that are run before any is timed: they load what most others use (windows, joins, Arrow workers, checkpoints)
WARM_UP = ["f05_cumulative_sum", "l07_order_value_by_category", "b07_box_two_keys", "i07_covariance"]


def main() -> None:
    directory = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("quern-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "16g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="quern-bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    for name in WARM_UP:
        QUERIES[name](spark, directory).write.format("noop").mode("overwrite").save()
    names = sys.argv[1:] or HEADLINE
    seconds = {}
    for name in names:
        times = []
        for _ in range(runs + 1):  # the first run compiles and does not count
            start = time.perf_counter()
            QUERIES[name](spark, directory).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:]), 4)
    spark.stop()
    print(json.dumps({
        "metric": "sum of median seconds over headline queries", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(directory.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
