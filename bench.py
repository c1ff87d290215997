"""Time the headline queries: prints one JSON line.

``BENCH_SF_DIR`` names the folder of tables and ``BENCH_CPUS`` the number of local cores. Every
query is executed in full (all rows and columns are computed and discarded).
"""

from __future__ import annotations

import json
import os
import time

from checks.queries import REGISTRY
from reviewmill.session import local_session
from reviewmill.sources.workspace import sweep

HEADLINE = (
    "flagship_clean_class_balance",
    "c9_clean",
    "c10_funnel",
    "t_all_text_metrics",
    "t17_model_tokens",
    "p1_column_inventory",
    "p16_quality_report",
    "p17_corpus_summary",
    "p24_describe_text_metrics",
    "p26_vocabulary_size",
    "p27_iqr_outliers",
    "g1_branch_report",
    "g9_length_histogram",
    "g10_length_boxes",
    "r1_leakage_checks",
    "r2_spearman_matrix",
    "n1_top_unigrams",
    "n2_top_bigrams",
    "n4_top_bigrams_by_class",
    "l1_stratified_split",
    "f2_tfidf_weights",
    "f4_feature_matrix",
    "f6_feature_vectors",
    "m5_feature_splits",
    "m4_naive_bayes",
    "m6_train_and_evaluate",
    "e7_leaderboard",
    "e10_bootstrap_interval",
    "m7_cross_validation",
    "m2_table_logistic",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores)
    REGISTRY["p21_rating_distribution"](spark, folder).collect()  # start the executors' code paths
    times = {}
    for name in HEADLINE:
        start = time.perf_counter()
        REGISTRY[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    total = round(sum(times.values()), 3)
    print(
        json.dumps(
            {
                "metric": "headline queries, total wall time",
                "value": total,
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    sweep(spark)
    spark.stop()


if __name__ == "__main__":
    main()
