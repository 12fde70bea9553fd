"""The public run_* entry points end to end (light settings, smallest scale)."""

import json

from pyspark.sql import functions as F

from astroframe.session import scratch_path
from tests.conftest import SF_SMALL


def read_text(spark, path):
    return spark.read.text(path, wholetext=True).first()["value"]


def test_etl_counts_follow_the_written_partitions(spark):
    from astroframe.operators.clean import rows_removed
    from astroframe.plans.runs import run_etl
    from astroframe.sources.fixtures import bodies

    raw = bodies(spark, SF_SMALL)
    processed, stats = run_etl(raw)
    keep = F.col("e").isNotNull() & F.col("a").isNotNull() & (F.col("e") >= 0)
    want = rows_removed(raw, keep).first().asDict()
    assert {k: stats[k] for k in want} == want and processed.count() == stats["kept"]
    pruned = processed.where(F.col("object_type") == "ISO")
    assert "PartitionFilters: [isnotnull(object_type" in pruned._jdf.queryExecution().executedPlan().toString()


def test_comparison_without_documents_and_with_indented_ones(spark):
    from astroframe.plans.runs import run_comparison

    base = scratch_path(spark, "docs")
    table, recs = run_comparison(spark, f"{base}/none", f"{base}/none")
    assert table.count() == 0 and recs.count() == 0
    doc = {"task1": None, "task2": {"n_anomalies": 3, "interstellar_detected": True, "train_time": 1.5}, "total_time": None}
    spark.createDataFrame([(json.dumps(doc, indent=2),)], "value string").coalesce(1).write.text(f"{base}/ml")
    row = run_comparison(spark, f"{base}/ml", f"{base}/none")[0].first()
    assert (row["modelo"], row["n_anomalies"], row["iso_detected"], row["train_time"], row["infer_time"]) == (
        "Isolation Forest", 3, True, 1.5, 0.0)


def test_run_all_light(spark):
    from astroframe.plans.runs import run_all

    out = scratch_path(spark, "run_all")
    report = run_all(spark, SF_SMALL, out, light=True)
    failed = {k: v for k, v in report.items() if isinstance(v, dict) and v.get("ok") is False}
    assert not failed, failed
    again = run_all(spark, SF_SMALL, out, light=True)  # everything is committed: nothing is run again
    assert [s for s, r in again.items() if r.get("ran")] == [] and again["etl_stats"] == report["etl_stats"]
    stats = report["etl_stats"]
    assert stats["total"] == stats["kept"] + stats["dropped"] and stats["types"]["ISO"] > 0
    ml = json.loads(read_text(spark, f"{out}/ml_results"))
    t1 = ml["task1"]
    assert set(t1["results"]) == {"Random Forest", "SVM", "Gradient Boosting"}
    for m in t1["results"].values():
        assert 0 <= m["accuracy"] <= 1 and len(m["confusion_matrix"]) == len(t1["classes"])
    assert ml["task2"]["n_anomalies"] >= 1 and -1 <= ml["task2"]["silhouette"] <= 1
    dl = json.loads(read_text(spark, f"{out}/dl_results"))
    assert dl["task1"]["epochs_trained"] == len(dl["task1"]["history"]["loss"]) >= 1
    assert dl["task1"]["total_params"] > 0 and dl["task2"]["method"] == "Autoencoder"
    for t in ("task1", "task3"):
        assert len(dl[t]["history"]["val_loss"]) == dl[t]["epochs_trained"] and min(dl[t]["history"]["val_loss"]) > 0 and dl[t]["infer_time"] > 0
    table = spark.read.json(f"{out}/comparison_table")
    assert table.count() == 8 and {"infer_time", "memory_mb", "iso_detected"} <= set(table.columns)
    recs = {r["tarea"] for r in spark.read.json(f"{out}/recommendations").collect()}
    assert "Deteccion de Anomalias (Interestelares)" in recs
    assert spark.read.parquet(f"{out}/processed").count() == stats["kept"]


def test_a_run_that_was_killed_goes_on_where_it_stopped(spark, monkeypatch):
    from astroframe.plans import runs

    ran = []

    def step(name, result):
        def run(*a, **k):
            ran.append(name)
            if name == "anomaly" and ran.count("anomaly") == 1:
                raise RuntimeError("killed")
            return result
        return run

    doc = {"task": "t", "method": "m", "accuracy": 0.5, "train_time": 1.0}
    for name in ("classification", "anomaly", "spectral"):
        monkeypatch.setattr(runs, f"run_{name}", step(name, (doc, doc)))
    monkeypatch.setattr(runs, "run_comparison", lambda *a: (spark.range(1), spark.range(1)))
    out = scratch_path(spark, "resumed")
    first = runs.run_all(spark, SF_SMALL, out)
    assert not first["anomaly"]["ok"] and first["comparison"]["ok"] and ran == ["classification", "anomaly", "spectral"]
    second = runs.run_all(spark, SF_SMALL, out)
    assert ran[3:] == ["anomaly"] and second["comparison"]["ran"]
    assert second["anomaly"]["ok"] and not second["etl"]["ran"] and not second["spectral"]["ran"]
    runs.run_all(spark, SF_SMALL, out, light=True)  # other settings: the models' steps are run again, the ETL is not
    assert ran[4:] == ["classification", "anomaly", "spectral"]
