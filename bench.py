"""Time the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from campaign_engine.catalog import load
from campaign_engine.catalog.models import training_tables
from campaign_engine.session import local_session

HEADLINES = [
    "agg_country_sub",
    "clean_pipeline",
    "clean_encoded",
    "validate_schema",
    "quality_metrics",
    "stats_compare",
    "describe_numeric",
    "boxplot_stats",
    "corr_spearman",
    "histogram",
    "pivot_channel",
    "eng_features",
    "score_percentile",
    "roc_auc",
    "best_f1_threshold",
    "threshold_sweep",
    "top_targets",
    "split_stratified",
    "cv_folds",
    "silhouette",
    "kmeans",
    "elbow",
    "lr_classifier",
    "rf_classifier",
    "campaign_scores",
    "random_search_light",
    "rf_regressor",
    "compare_versions_table",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    picked = os.environ.get("BENCH_QUERIES")
    spark = local_session("campaign-bench", cpus)
    queries, _ = load()
    small = sf_dir.replace("sf0.1", "sf0.001")
    queries["agg_country_sub"](spark, small if os.path.isdir(small) else sf_dir).collect()  # warm-up, not timed
    training_tables(spark, sf_dir)  # prepared untimed, so that no query's time depends on the order
    times: dict[str, float] = {}
    for name in picked.split(",") if picked else HEADLINES:
        spark.catalog.clearCache()
        start = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "total_query_time",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
    }))
    spark.stop()


if __name__ == "__main__":
    main()
