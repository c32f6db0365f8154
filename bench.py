"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from harborline.plans.registry import all_queries  # noqa: E402
from harborline.session import local_session  # noqa: E402

HEADLINE = (
    "daily_aggregate",
    "panel_features",
    "rolling_stats",
    "baseline_metrics",
    "metrics_by_branch",
    "iqr_clip",
    "describe",
    "null_profile",
    "dedupe_rows",
    "join_inner",
    "join_outer",
    "agg_group_multi",
    "pivot_sum",
    "topn_per_group",
    "prev_growth",
    "share_of_total",
    "corr_matrix",
    "linear_regression",
    "chunk_words",
    "vector_topk",
    "search_documents",
    "recursive_forecast",
    "redistribute",
    "half_day_totals",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), os.environ.get("BENCH_MEMORY", "12g"), "bench")
    registered = all_queries()
    run = lambda name: registered[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").groupBy("l_returnflag").count().collect()  # start the JVM's threads
    seconds, warm = {}, {}
    for name in sys.argv[1:] or HEADLINE:
        start = time.perf_counter()
        run(name)
        seconds[name] = round(time.perf_counter() - start, 3)
        start = time.perf_counter()
        run(name)
        warm[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "total time of headline queries, first run of each",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "warm": warm,
                "warm_total": round(sum(warm.values()), 3),
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
