"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (tables) and BENCH_CPUS (cores) choose the data and the machine's share.
"""

from __future__ import annotations

import json
import os
import sys
import time

from scorewright.plans import catalogue, views
from scorewright.session import local_session

HEADLINES = [
    "headline", "applicants_view", "classification_report", "roc_auc_lineitem", "pr_curve",
    "threshold_grid", "join_cross_grid", "group_outcome", "fairness_ext", "threshold_frontier",
    "calibration_bins", "profile_lineitem", "feature_target_corr", "mutual_info_target",
    "reweigh", "selection_summary", "split_group_stratified",
    "split_temporal", "overlap_check", "topk_drivers", "scenario_exposure",
    "sensitivity_flip", "feature_group_assoc", "join_nearest", "train_logistic", "threshold_optimizer",
    "train_boosted",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, "scorewright-bench")
    start = time.time()
    views.features(spark, sf_dir)
    seconds = {"write_features": round(time.time() - start, 3)}
    for name in HEADLINES:
        start = time.time()
        catalogue.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.time() - start, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
