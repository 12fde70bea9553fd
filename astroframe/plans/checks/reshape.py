"""2.9 set operations and reshaping."""

from __future__ import annotations

from pyspark.sql import functions as F

from astroframe.constants import ANOMALY_MODELS, RECOMMENDATION_TASKS, RECOMMENDATION_TEXTS, TASK_LABELS
from astroframe.operators import reshape as R
from astroframe.plans.registry import query, sql_rounded
from astroframe.sources.fixtures import bodies, model_runs


def _case(col: str, mapping: dict) -> str:
    return "CASE " + col + " " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items()) + f" ELSE {col} END"


@query("union_by_name",
       "SELECT spkid, e, a, \"H\", NULL::DOUBLE AS q FROM bodies WHERE kind = 'a' UNION ALL "
       "SELECT spkid, e, a, NULL::DOUBLE AS \"H\", q FROM bodies WHERE kind = 'c'", views=["bodies"])
def q_union_by_name(spark, sf):
    b = bodies(spark, sf)
    ast = b.where(F.col("kind") == "a").select("spkid", "e", "a", "H")
    com = b.where(F.col("kind") == "c").select("spkid", "q", "e", "a")
    return R.union_by_name(ast, com)


#: what the comparison shows of the documents that :func:`run_documents` makes
COMPARISON_SQL = f"""
SELECT {_case('task', TASK_LABELS)} AS tarea, approach AS enfoque,
 CASE WHEN task = 'anomaly_detection' THEN {_case('approach', ANOMALY_MODELS)} ELSE model END AS modelo,
 CASE WHEN task = 'anomaly_detection' THEN 0.0e0 ELSE coalesce(accuracy, 0.0e0) END AS accuracy,
 CASE WHEN task = 'anomaly_detection' THEN 0.0e0 ELSE coalesce(f1, 0.0e0) END AS f1,
 CASE WHEN task = 'object_classification' THEN coalesce(accuracy / 2.0e0, 0.0e0) ELSE 0.0e0 END AS precision,
 0.0e0 AS recall, coalesce(train_time, 0.0e0) AS train_time,
 CASE WHEN task = 'anomaly_detection' AND approach = 'ML' THEN 0.0e0 ELSE coalesce(train_time / 8.0e0, 0.0e0) END AS infer_time,
 CASE WHEN approach = 'ML' THEN n_anomalies * 1.5e0 ELSE 0.0e0 END AS memory_mb,
 CASE WHEN task = 'anomaly_detection' THEN n_anomalies END AS n_anomalies,
 CASE WHEN task = 'anomaly_detection' THEN n_anomalies % 2 = 0 END AS iso_detected FROM model_runs"""


def run_documents(runs):
    """Result documents of both kinds, one per model of ``model_runs`` (column ``model`` names the file)."""
    m = runs.withColumns({
        "precision": F.col("accuracy") / 2.0, "infer_time": F.col("train_time") / 8.0, "memory_mb": F.col("n_anomalies") * 1.5,
        "interstellar_detected": F.col("n_anomalies") % 2 == 0, "method": F.col("model")})
    is_ = {n: F.col("task") == t for n, t in zip(("task1", "task2", "task3"), TASK_LABELS)}
    metrics = F.struct("accuracy", "f1", "precision", "train_time", "infer_time", "memory_mb")
    one = F.struct("method", "accuracy", "f1", "precision", "train_time", "infer_time", "memory_mb")
    anomaly = F.struct("method", "n_anomalies", "train_time", "infer_time", "memory_mb", "interstellar_detected")
    by_model = {"ML": F.struct(F.create_map("model", metrics).alias("results")), "DL": one}
    out = []
    for approach, task1 in by_model.items():
        docs = m.where(F.col("approach") == approach)
        out.append(docs.select(F.concat_ws("-", "task", "model").alias("model"), F.when(is_["task1"], task1).alias("task1"),
                               F.when(is_["task2"], anomaly).alias("task2"), F.when(is_["task3"], one).alias("task3")))
    return out


@query("comparison_table", COMPARISON_SQL, views=["model_runs"])
def q_comparison_table(spark, sf):
    ml, dl = run_documents(model_runs(spark, sf))
    return R.comparison_table(R.union_by_name(R.classical_rows(ml), R.network_rows(dl)))


@query("melt_metrics",
       "SELECT task, approach, model, 'accuracy' AS metric, accuracy AS value FROM model_runs UNION ALL "
       "SELECT task, approach, model, 'f1', f1 FROM model_runs UNION ALL "
       "SELECT task, approach, model, 'train_time', train_time FROM model_runs", views=["model_runs"])
def q_melt_metrics(spark, sf):
    return R.melt_metrics(model_runs(spark, sf), ["task", "approach", "model"], ["accuracy", "f1", "train_time"])


@query("explode_history",
       "SELECT task, approach, CAST(row_number() OVER (PARTITION BY task, approach ORDER BY model) AS INTEGER) AS epoch, "
       "train_time AS loss, n_anomalies AS val_loss FROM model_runs", views=["model_runs"])
def q_explode_history(spark, sf):
    m = model_runs(spark, sf)
    h = m.groupBy("task", "approach").agg(
        F.array_sort(F.collect_list(F.struct("model", "train_time", "n_anomalies"))).alias("runs"))
    h = h.select("task", "approach", F.col("runs.train_time").alias("loss"), F.col("runs.n_anomalies").alias("val_loss"))
    return R.explode_history(h, ["task", "approach"], {"loss": "loss", "val_loss": "val_loss"})


@query("records_to_rows", "SELECT task, model, accuracy, train_time FROM model_runs", views=["model_runs"])
def q_records_to_rows(spark, sf):
    m = model_runs(spark, sf)
    docs = m.groupBy("task").agg(F.collect_list(F.struct("model", "accuracy", "train_time")).alias("records"))
    return R.records_to_rows(docs, "records", ["task"])


_REC = f"""
WITH s AS (SELECT * FROM model_runs WHERE accuracy > 0),
 b AS (SELECT task, model AS best, accuracy AS acc FROM (SELECT *, row_number() OVER (PARTITION BY task
       ORDER BY accuracy DESC, model) AS rn FROM s) t WHERE rn = 1),
 f AS (SELECT task, model AS fastest, train_time AS tt FROM (SELECT *, row_number() OVER (PARTITION BY task
       ORDER BY train_time, model) AS rn FROM s WHERE train_time IS NOT NULL) t WHERE rn = 1),
 k AS (SELECT DISTINCT task FROM model_runs)
SELECT {_case('k.task', RECOMMENDATION_TASKS)} AS tarea,
 CASE WHEN best IS NOT NULL THEN best || ' (' || printf('%.4f', {sql_rounded('acc', 4)}) || ')' END AS mejor_accuracy,
 CASE WHEN k.task = 'object_classification' AND fastest IS NOT NULL
      THEN fastest || ' (' || printf('%.2f', {sql_rounded('tt', 2)}) || 's)' END AS mas_rapido,
 {_case('k.task', RECOMMENDATION_TEXTS)} AS recomendacion
FROM k LEFT JOIN b ON k.task = b.task LEFT JOIN f ON k.task = f.task
WHERE k.task = 'anomaly_detection' OR best IS NOT NULL
"""


@query("recommendations", _REC, views=["model_runs"])
def q_recommendations(spark, sf):
    return R.recommendations(model_runs(spark, sf))


@query("summary_table",
       "SELECT task, model, coalesce(printf('%.4f', " + sql_rounded("accuracy", 4) + "), '-') AS accuracy, "
       "coalesce(printf('%.4f', " + sql_rounded("f1", 4) + "), '-') AS f1, "
       "coalesce(printf('%.2f', " + sql_rounded("train_time", 2) + "), '-') AS train_time, "
       "coalesce(printf('%.4f', " + sql_rounded("train_time / 8.0e0", 4) + "), '-') AS infer_time FROM model_runs",
       views=["model_runs"])
def q_summary_table(spark, sf):
    runs = model_runs(spark, sf).withColumn("infer_time", F.col("train_time") / 8.0)
    return R.summary_table(runs, {"accuracy": 4, "f1": 4, "train_time": 2, "infer_time": 4}, ["task", "model"])
