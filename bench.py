"""Headline queries, warm, median of three, as one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_RUNS (default 3).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemill.plans import registry  # noqa: E402
from tidemill.session import build_session  # noqa: E402

HEADLINE = [
    "avg_by_key",  # the shape of the one published run: average rating per product
    "avg_with_names",
    "rating_histogram",
    "word_count_ws",
    "word_count_space",
    "median_quantiles",
    "rank_topn",
    "running_sum_product",
    "rolling_1_7_30d",
    "dim_twice",
    "similar_topn",
    "pair_rules",
    "pagerank_raw",
    "bfs_paths",
    "zone_trip_totals",
    "nearest_pairs",
    "mann_whitney",
    "bootstrap_mean",
    "tfidf_sql",
    "roc_pr_auc",
    "knn_vote",
    "dbscan",
    "stream_sliding",
    "stream_upsert",
]


def main() -> None:
    base = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    registry.load_all()
    conf = {
        "spark.sql.shuffle.partitions": cpus if cpus.isdigit() else "8",
        "spark.driver.memory": "16g",
        "spark.ui.showConsoleProgress": "false",
    }
    spark = build_session("bench", f"local[{cpus}]", **conf)
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}
    for name in names:
        run = registry.runner(registry.JOBS[name])
        taken = []
        for _ in range(runs + 1):  # the first one warms up
            start = time.perf_counter()
            run(spark, base).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
            if taken[0] > 8 and len(taken) == 2:  # a long query is measured once
                break
        seconds[name] = round(statistics.median(taken[1:]), 3)
        print(f"{name}: {seconds[name]} (first {taken[0]:.1f})", file=sys.stderr, flush=True)
    sf = os.path.basename(base.rstrip("/")).removeprefix("sf")
    line = {"metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": sf}
    print(json.dumps(line))
    spark.stop()


if __name__ == "__main__":
    main()
