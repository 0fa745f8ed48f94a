"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the tables (default sf0.1), ``BENCH_CPUS`` the cores,
``BENCH_QUERIES`` an optional comma-separated choice of queries.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

from shelfcast.plans.catalog import QUERIES
from shelfcast.session import local_session

HEADLINE = [
    "dept_sales", "growth_rate", "rolling_means_dept", "grid", "features", "melt_sales", "join_prices", "category_codes",
    "item_share", "holdout_sample", "hierarchy_rollup", "revenue_weights", "rmsse", "wrmsse", "wrmsse_models",
    "join_models", "blend", "stack_weights", "stack_apply", "top_down", "submission", "recursive_seasonal",
    "recursive_forecast", "per_series_forecast", "topdown_volume", "blend_search", "wrmsse_recursive", "alpha_ensemble",
    "recursive_model", "tune_per_series", "bootstrap_mean", "recursive_in_partition", "stored_features", "trend_law",
    "share_loglinear", "refit_volume", "out_of_fold_encode", "sparse_matrix",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench")
    QUERIES["dept_sales"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
    times = {}
    for name in names:
        start = time.perf_counter()
        # the noop sink computes every row and column, and keeps them off the driver
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        print(name, times[name], file=sys.stderr, flush=True)
    scale = re.search(r"sf([\d.]+)", sf_dir)
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": float(scale.group(1)) if scale else None,
    }))


if __name__ == "__main__":
    main()
