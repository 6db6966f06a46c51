"""Headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS]; prints one JSON line.

Every query runs once to warm the JVM and once for the clock, with its whole
result consumed and the cache cleared in between.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from riskspark.catalog import queries  # noqa: E402
from riskspark.session import local_session  # noqa: E402

HEADLINE = (
    "jb03_score", "jb02_features", "jb01_preprocess", "jb05_held_out_evaluation", "jb06_explanations",
    "wn01_velocity_1h", "wn01b_velocity_hot_cards", "sp01_stratified_split", "cl07_cleaning_log", "ag03_category_median",
    "ag08_cardinality", "ag16_label_correlations", "ag17_correlation_matrix", "ev03_pr_auc", "ev09_weight_grid",
    "cf03_cost_sweep", "lk06_audit_report", "tk03_top_factors", "jn08_orders_baseline", "ml10_iforest_fit",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), app="riskspark-bench")
    spark.sparkContext.setLogLevel("ERROR")
    registered, times = queries(), {}
    for name in HEADLINE:
        for _ in range(2):
            spark.catalog.clearCache()
            start = time.perf_counter()
            registered[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - start, 3)
    total = round(sum(times.values()), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": times, "sf": sf}))


if __name__ == "__main__":
    main()
