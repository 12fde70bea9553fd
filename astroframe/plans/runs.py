"""Public entry points: the reference's steps as Spark jobs.

``run_etl`` -> ``run_classification`` / ``run_anomaly`` / ``run_spectral``
(classical and network models) -> ``run_comparison``; ``run_all`` chains
them and keeps going when one step fails.  Result documents hold metrics
only; row-level outputs (coordinates, scores, predictions) are written as
distributed datasets next to them.
"""

from __future__ import annotations

import json
import time
import traceback

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from astroframe import schema as SC
from astroframe.constants import ANOMALY_MODELS, ML_PARAMS, NORMAL_TYPES, RESULT_TASKS
from astroframe.models import anomaly as AN
from astroframe.models import classifiers as M
from astroframe.models.distance import silhouette
from astroframe.models.evaluate import evaluation_dict
from astroframe.models.frames import anomaly_frame, classification_frame, spectral_frame
from astroframe.operators import reshape as R
from astroframe.operators.aggregate import all_detected, count_by
from astroframe.operators.features import etl_full
from astroframe.plans.manifest import RunManifest, digest
from astroframe.session import scratch_path
from astroframe.sources import catalog_io as IO


def _timed(fn, *a, **k):
    t0 = time.time()
    out = fn(*a, **k)
    return out, time.time() - t0


def _write_doc(spark: SparkSession, doc: dict, path: str) -> None:
    """One indented JSON document."""
    spark.createDataFrame([(json.dumps(doc, default=float, indent=2),)], "value string").coalesce(1) \
        .write.mode("overwrite").text(path)


def run_etl(raw: DataFrame, out_path: str | None = None) -> tuple[DataFrame, dict]:
    """Clean, engineer, classify: one scan of ``raw``'s columns, which writes the partitioned output.

    The type counts, and with them the rows kept, come from the written
    partitions; the rows in are a count without columns (Parquet answers it
    from its footers).
    """
    out_path = out_path or scratch_path(raw.sparkSession, "processed")
    result = etl_full(raw)
    IO.write_catalog(result, out_path)
    processed = raw.sparkSession.read.schema(result.schema).parquet(out_path)
    types = {r["object_type"]: r["count"] for r in count_by(processed, "object_type").collect()}
    total, kept = raw.count(), sum(types.values())
    return processed, {"total": total, "kept": kept, "dropped": total - kept, "types": types}


def _judged(fit, *a, **k) -> tuple[dict, object]:
    """Fit and evaluate a classifier: metrics with train_time and infer_time, and what else it returned."""
    out, train_time = _timed(fit, *a, **k)
    pred, extra = out if isinstance(out, tuple) else (out, None)
    metrics, infer_time = _timed(evaluation_dict, pred)
    return {**metrics, "train_time": train_time, "infer_time": infer_time}, extra


def run_classification(processed: DataFrame, rf=None, gbt=None, svm=None, mlp=None) -> tuple[dict, dict]:
    """Task 1: forest, kernel SVM, boosted trees (classical) and a dense network."""
    rf = {"trees": ML_PARAMS["rf_n_estimators"], "depth": ML_PARAMS["rf_max_depth"], **(rf or {})}
    gbt = {"rounds": ML_PARAMS["xgb_n_estimators"], "depth": ML_PARAMS["xgb_max_depth"], **(gbt or {})}
    train, test, cols, classes = classification_frame(processed)
    results = {}
    results["Random Forest"], imp = _judged(M.rf_classify, train, test, "spkid", **rf)
    importance = dict(sorted(zip(cols, imp), key=lambda kv: -kv[1]))
    results["SVM"], _ = _judged(M.svm_classify, train, test, "spkid", **(svm or {}))
    results["Gradient Boosting"], _ = _judged(M.boosted_classify, train, test, "spkid", **gbt)
    judged, record = _judged(M.mlp_classify, train, test, "spkid", len(cols), len(classes), with_history=True, **(mlp or {}))
    net = {"task": RESULT_TASKS["task1"], "method": "DNN", **judged, **record}
    classical = {"task": RESULT_TASKS["task1"], "classes": classes, "results": results, "feature_importance": importance}
    return classical, net


def run_anomaly(processed: DataFrame, out_path: str | None = None, starts: int = 10, net: dict | None = None) -> tuple[dict, dict]:
    """Task 2: PCA + k-means + silhouette + isolation forest; reconstruction anomaly."""
    df, cols = anomaly_frame(processed)
    coords, ratios = M.pca_project(df, ML_PARAMS["pca_components"])
    clustered, _, _ = M.kmeans_cluster(coords, ML_PARAMS["n_clusters"], starts, ML_PARAMS["random_state"])
    sil = silhouette(clustered, "spkid", cols, "cluster").first()["silhouette"]
    scored, t = _timed(AN.isolation_forest, clustered, "spkid", cols, 100, 256,
                       ML_PARAMS["isolation_contamination"], 42)
    iso = F.col("object_type") == "ISO"
    summary = scored.agg(F.count_if(F.col("anomaly_score") == -1).alias("n"),
                         all_detected(F.col("anomaly_score") == -1, iso).alias("det")).first()
    if out_path:
        scored.select("full_name", "object_type", "pc1", "pc2", "pc3", "cluster", "anomaly_score",
                      "anomaly_score_raw").write.mode("overwrite").json(f"{out_path}/pca_coords")
    classical = {"task": RESULT_TASKS["task2"], "method": ANOMALY_MODELS["ML"], "n_anomalies": summary["n"],
                 "silhouette": sil, "pca_variance": ratios, "train_time": t,
                 "interstellar_detected": summary["det"]}
    (rec, thr, record), t = _timed(AN.reconstruction_anomaly, df, cols, F.col("object_type").isin(*NORMAL_TYPES), **(net or {}))
    s2 = rec.agg(F.sum("recon_anomaly").alias("n"),
                 all_detected(F.col("recon_anomaly") == 1, iso).alias("det")).first()
    if out_path:
        rec.where(iso).select("full_name", F.col("recon_error").alias("ae_recon_error"),
                              F.col("recon_anomaly").alias("ae_anomaly")) \
           .write.mode("overwrite").json(f"{out_path}/interstellar_errors")
    net = {"task": RESULT_TASKS["task2"], "method": ANOMALY_MODELS["DL"], "n_anomalies": int(s2["n"] or 0),
           "threshold": thr, "train_time": t, "interstellar_detected": s2["det"], **record}
    return classical, net


def run_spectral(galaxies: DataFrame, trees: int = ML_PARAMS["rf_n_estimators"], net: dict | None = None) -> tuple[dict, dict]:
    """Task 3: redshift classes from colours -- forest (depth 15) and a convolutional network."""
    train, test, cols, classes = spectral_frame(galaxies)
    judged, imp = _judged(M.rf_classify, train, test, "gal_id", trees, 15)
    classical = {"task": RESULT_TASKS["task3"], "method": "Random Forest", **judged, "class_names": classes,
                 "feature_importance": dict(zip(cols, imp))}
    judged, record = _judged(M.cnn_classify, train, test, "gal_id", len(cols), len(classes), with_history=True, **(net or {}))
    net = {"task": RESULT_TASKS["task3"], "method": "1D-CNN", **judged, "class_names": classes, **record}
    return classical, net


def run_comparison(spark: SparkSession, classical_path: str, network_path: str) -> tuple[DataFrame, DataFrame]:
    """Comparison table and per-task recommendations from the saved result documents.

    An absent or corrupt document leaves its rows out.
    """
    rows = R.union_by_name(R.classical_rows(IO.read_result_json(spark, classical_path, SC.CLASSICAL_RESULTS)),
                           R.network_rows(IO.read_result_json(spark, network_path, SC.NETWORK_RESULTS)))
    return R.comparison_table(rows), R.recommendations(rows)


def run_all(spark: SparkSession, sf_dir: str, out_dir: str, light: bool = False) -> dict:
    """Every step in order; a failing step is reported and the later steps that do not need it go on.

    Each step that ends is entered in ``out_dir``/manifest; a second call with the same inputs and settings runs only
    what is missing.  ``light`` is for trials: smaller forests, fewer rounds, starts and epochs.
    """
    from astroframe.sources.fixtures import bodies, galaxies

    manifest = RunManifest(spark, f"{out_dir}/manifest")
    forest, starts = ({"trees": 50, "depth": 12}, 3) if light else ({"trees": ML_PARAMS["rf_n_estimators"], "depth": ML_PARAMS["rf_max_depth"]}, 10)
    boost = {"rounds": 10, "depth": 5} if light else {"rounds": ML_PARAMS["xgb_n_estimators"], "depth": ML_PARAMS["xgb_max_depth"]}
    net = {"epochs": 5} if light else {}
    report: dict = {}
    done: dict[str, dict] = {}

    def processed() -> DataFrame:
        return spark.read.schema(SC.PROCESSED).parquet(f"{out_dir}/processed")

    def etl() -> dict:
        return run_etl(bodies(spark, sf_dir), f"{out_dir}/processed")[1]

    def classification() -> dict:
        return dict(zip(("ml", "dl"), run_classification(processed(), rf=forest, gbt=boost, mlp=net)))

    def anomaly() -> dict:
        return dict(zip(("ml", "dl"), run_anomaly(processed(), f"{out_dir}/anomaly", starts, net)))

    def spectral() -> dict:
        return dict(zip(("ml", "dl"), run_spectral(galaxies(spark, sf_dir), forest["trees"], net)))

    def comparison() -> dict:
        for kind in ("ml", "dl"):
            tasks = {f"task{i}": done[name][kind] for i, name in enumerate(("classification", "anomaly", "spectral"), 1) if name in done}
            _write_doc(spark, tasks, f"{out_dir}/{kind}_results")
        table, recs = run_comparison(spark, f"{out_dir}/ml_results", f"{out_dir}/dl_results")
        table.write.mode("overwrite").json(f"{out_dir}/comparison_table")
        recs.write.mode("overwrite").json(f"{out_dir}/recommendations")
        return {"models": spark.read.json(f"{out_dir}/comparison_table").count()}

    def written(*paths: str):
        return lambda _: all(IO.path_exists(spark, f"{out_dir}/{p}/_SUCCESS") for p in paths)

    tables = manifest.inputs([f"{sf_dir.rstrip('/')}/{t}.parquet" for t in ("orders", "embeddings")])
    steps = [("etl", etl, [], {}, written("processed")), ("classification", classification, ["etl"], {"rf": forest, "gbt": boost, **net}, None),
             ("anomaly", anomaly, ["etl"], {"starts": starts, **net}, written("anomaly/pca_coords", "anomaly/interstellar_errors")),
             ("spectral", spectral, [], {"trees": forest["trees"], **net}, None),
             ("comparison", comparison, ["classification", "anomaly", "spectral"], {}, written("comparison_table", "recommendations"))]
    for name, fn, needs, parameters, still_there in steps:
        t0 = time.time()
        try:
            if missing := [n for n in needs if n not in done and name != "comparison"]:
                raise RuntimeError(f"needs {', '.join(missing)}")
            seen = digest([tables, {n: done.get(n) for n in needs}])
            done[name], ran = manifest.step(name, seen, parameters, fn, still_there)
            report[name] = {"ok": True, "ran": ran, "seconds": round(time.time() - t0, 2)}
        except Exception as ex:  # noqa: BLE001 - keep going, like the reference
            report[name] = {"ok": False, "error": str(ex)[:500], "trace": traceback.format_exc()[-1500:]}
    if "etl" in done:
        report["etl_stats"] = done["etl"]
    return report
