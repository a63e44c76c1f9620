"""Benchmark: run the headline catalogue queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed in full with the ``noop`` sink (every row computed, nothing
collected to the driver).  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "daily_best_worst", "daily_rank", "top2_per_supplier", "part_price_vs_global", "verb_chain",
    "global_profile", "multi_distinct", "group_mean_count", "having_delay", "crosstab_long",
    "join_natural", "join_kinds", "set_ops", "block_kfold", "holdout_capped", "pairwise_t",
    "boxplot_by_group", "histogram_w5", "string_index", "drop_fill", "interpolate", "clip_outliers",
    "regression_metrics", "split_mse", "ols_line", "kmeans_fit", "pca_centered", "logistic_fit",
    "rf_validation", "gbt_regression", "network_regression", "glm_path",
    "grid_full", "grid_random", "gbm_multiclass", "gbm_regression_parity",
]


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from sparkdeck.plans import queries
    from sparkdeck.session import get_session
    spark = get_session(f"local[{cpus}]", shuffle_partitions=int(cpus) * 2,
                        extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEM", "16g")})
    qs = queries()
    names = [n for n in (sys.argv[1:] or HEADLINE) if n in qs]
    # warm-up: JVM, Python workers and file listing
    qs["global_mean"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for n in names:
        t0 = time.perf_counter()
        qs[n](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[n] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
