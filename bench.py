"""Bench: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints ONE JSON line.

Every query runs to completion through the ``noop`` sink (full execution,
no driver collect).  The metric is the sum of the per-query wall times.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "etl_full", "count_by_type", "rows_removed", "exact_median", "impute_median", "standardize",
    "column_moments", "covariance_matrix", "stratified_split", "sample_per_group", "semi_valid_classes",
    "label_encode", "confusion_matrix", "weighted_prf", "histogram", "trailing_window", "kmeans_assign",
    "silhouette", "hyperbolic_path", "hyperbolic_path_3d", "frame_sample", "comparison_table",
    "recommendations", "isolation_forest", "reconstruction_anomaly", "pca_project",
]
PROBES = ["rf_classify", "mlp_classify", "svm_classify", "boosted_classify", "kmeans_cluster"]
PROBE_SF = "sf0.01"


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    from astroframe.session import local_session

    spark = local_session(cpus, shuffle_partitions=max(8, 2 * cpus))
    spark.sparkContext.setLogLevel("ERROR")
    from astroframe.plans.registry import load_all

    reg = load_all()
    probe_dir = os.path.join(os.path.dirname(sf_dir.rstrip("/")), PROBE_SF)
    jobs = [(n, n, sf_dir) for n in (sys.argv[1:] or HEADLINE) if n in reg]
    if not sys.argv[1:] and os.path.isdir(probe_dir):
        jobs += [(f"{n}@{PROBE_SF}", n, probe_dir) for n in PROBES if n in reg]
    # warm-up: JVM, Python workers and the parquet footers, outside the timings
    reg["count_by_type"].spark(spark, sf_dir).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for label, name, where in jobs:
        t0 = time.time()
        reg[name].spark(spark, where).write.format("noop").mode("overwrite").save()
        times[label] = round(time.time() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": float(sf) if sf else sf_dir}))
    spark.stop()


if __name__ == "__main__":
    main()
