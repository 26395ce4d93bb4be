"""Headline queries on ``$BENCH_SF_DIR`` with ``local[$BENCH_CPUS]``; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks import QUERIES  # noqa: E402
from tabulon.session import local_session  # noqa: E402

HEADLINE = [
    "numeric_summary", "table_info", "correlation_matrix", "boxplot_stats", "smart_impute",
    "iqr_filter", "dedupe", "split_three_way", "kfold_assign", "feature_pipeline",
    "standard_scale", "metrics", "residual_stats", "compare_models", "pairwise_diff", "qq_line",
    "score_batch", "contributions_topn", "validate_rows", "csv_scan", "grid_search_ridge",
    "grid_search_lasso", "cross_validate", "learning_curve", "quick_plan", "full_plan",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, shuffle_partitions=int(cpus))
    spark.sparkContext.setLogLevel("OFF")
    spark.range(1000).selectExpr("sum(id)").collect()          # start-up is not measured
    times = {}
    for name in names:
        start = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - start, 3)
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")), "cpus": cpus}))


if __name__ == "__main__":
    main()
