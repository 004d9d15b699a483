"""Benchmark: run the headline queries on ``$BENCH_SF_DIR`` (default
/root/testdata/sf0.1) with ``local[$BENCH_CPUS]`` and print one JSON line.

Each query is executed to completion into Spark's ``noop`` sink (the whole
plan runs, nothing is collected to Python); queries whose driver loop
already runs jobs (graph searches, model fits) are timed end to end.  One
warm-up query runs first so JVM start-up and class loading are not charged
to the first query.  Per-query time is the best of ``$BENCH_REPEAT`` runs
(default 2); ``value`` is the sum over queries.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tessera.plans.catalogue import QUERIES  # noqa: E402
from tessera.session import build_session, scratch_scope  # noqa: E402

HEADLINE = [
    "rating_histogram",
    "item_popularity",
    "item_popularity_named",
    "int_mean_by_key",
    "customer_totals",
    "min_reading_by_key",
    "word_count",
    "word_count_top",
    "most_connected",
    "degree_top",
    "hop_distance",
    "bfs_hits",
    "item_similarity",
    "similar_items",
    "sql_range",
    "linear_regression",
    "regression_rmse",
    "als_recommend",
]


def run(spark, name: str, sf_dir: str) -> float:
    with scratch_scope(spark):      # drop the run's intermediate tables afterwards
        t0 = time.perf_counter()
        df = QUERIES[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "2"))
    # initial shuffle width; AQE coalesces small partitions at run time
    shuffle = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", str(cpus)))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(f"local[{cpus}]", shuffle_partitions=shuffle,
                          extra={"spark.driver.memory": "8g"})
    run(spark, "rating_histogram", sf_dir)  # warm-up
    times = {}
    for n in names:
        try:
            times[n] = round(min(run(spark, n, sf_dir) for _ in range(repeat)), 3)
        except Exception as e:  # a failing query is reported, the rest still run
            print(f"{n} failed: {e}", file=sys.stderr)
            times[n] = None
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    total = round(sum(t for t in times.values() if t is not None), 3)
    print(json.dumps({"metric": "total_query_time", "value": total,
                      "unit": "sec", "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
