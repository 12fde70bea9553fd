"""2.6 aggregations."""

from __future__ import annotations

from pyspark.sql import functions as F

from astroframe.constants import FEATURES_ALL, FEATURES_ENGINEERED
from astroframe.operators import aggregate as A
from astroframe.plans.checks.etl import processed
from astroframe.plans.registry import query
from astroframe.sources.fixtures import bodies, model_runs
from astroframe.sources.tables import table

FEATS = FEATURES_ALL + FEATURES_ENGINEERED
MOMENT_COLS = FEATS


def _union(parts):
    return " UNION ALL ".join(parts)


@query("row_count", "SELECT count(*) AS n_rows FROM bodies", views=["bodies"])
def q_row_count(spark, sf):
    return A.row_count(bodies(spark, sf))


@query("value_counts",
       "SELECT object_type, count(*) AS count FROM processed WHERE object_type IS NOT NULL GROUP BY object_type",
       views=["processed"])
def q_value_counts(spark, sf):
    return A.value_counts(processed(spark, sf), "object_type")


@query("having_min_count",
       "SELECT object_type, count(*) AS count FROM processed WHERE object_type IS NOT NULL "
       "GROUP BY object_type HAVING count(*) >= 50", views=["processed"])
def q_having_min_count(spark, sf):
    return A.having_min_count(processed(spark, sf), "object_type", 50)


@query("distinct_types", "SELECT DISTINCT object_type FROM processed", views=["processed"])
def q_distinct_types(spark, sf):
    return A.distinct_types(processed(spark, sf), "object_type")


@query("exact_median",
       _union([f"SELECT '{c}' AS column, quantile_cont(\"{c}\", 0.5) AS median FROM processed" for c in FEATS]),
       views=["processed"], round_cols=["median"])
def q_exact_median(spark, sf):
    return A.quantile_table(processed(spark, sf), FEATS, 0.5, "median")


@query("percentile_threshold",
       "SELECT 'q_over_a_p99_normal' AS name, quantile_cont(q_over_a, 0.99) AS threshold FROM processed "
       "WHERE object_type IN ('MBA', 'NEO') UNION ALL "
       "SELECT 'energy_p01' AS name, quantile_cont(energy_param, 0.01) AS threshold FROM processed",
       views=["processed"], round_cols=["threshold"])
def q_percentile_threshold(spark, sf):
    p = processed(spark, sf)
    t1 = A.percentile_threshold(p, "q_over_a", 0.99, F.col("object_type").isin("MBA", "NEO"))
    t2 = A.percentile_threshold(p, "energy_param", 0.01)
    return spark.createDataFrame([("q_over_a_p99_normal", t1), ("energy_p01", t2)],
                                 "name string, threshold double")


@query("anomaly_rate",
       "SELECT count(*) FILTER (WHERE v_inf > 0) AS n_anomalies, count(*) AS n_rows, "
       "count(*) FILTER (WHERE v_inf > 0) / count(*) AS share FROM processed",
       views=["processed"], round_cols=["share"])
def q_anomaly_rate(spark, sf):
    return A.anomaly_rate(processed(spark, sf), F.col("v_inf") > 0)


@query("all_detected",
       "SELECT kind, bool_and(e > 1) FILTER (WHERE object_type = 'ISO') AS interstellar_detected "
       "FROM processed GROUP BY kind", views=["processed"])
def q_all_detected(spark, sf):
    p = processed(spark, sf)
    return p.groupBy("kind").agg(
        A.all_detected(F.col("e") > 1, F.col("object_type") == "ISO").alias("interstellar_detected"))


@query("column_moments",
       _union([f"SELECT '{c}' AS column, avg(\"{c}\") AS mean, stddev_pop(\"{c}\") AS std FROM processed"
               for c in MOMENT_COLS]),
       views=["processed"], round_cols=["mean", "std"])
def q_column_moments(spark, sf):
    return A.column_moments(processed(spark, sf), MOMENT_COLS)


@query("confusion_matrix",
       "WITH k AS (SELECT quality AS c FROM labels UNION SELECT toxic FROM labels), "
       "n AS (SELECT quality, toxic, count(*) AS cnt FROM labels GROUP BY ALL) "
       "SELECT a.c AS quality, b.c AS toxic, coalesce(n.cnt, 0) AS count FROM k a, k b "
       "LEFT JOIN n ON n.quality = a.c AND n.toxic = b.c")
def q_confusion_matrix(spark, sf):
    return A.confusion_matrix(table(spark, sf, "labels"), "quality", "toxic")


@query("accuracy",
       "SELECT avg(CASE WHEN quality = toxic THEN 1.0e0 ELSE 0.0e0 END) AS accuracy FROM labels",
       round_cols=["accuracy"])
def q_accuracy(spark, sf):
    return A.accuracy(table(spark, sf, "labels"), "quality", "toxic")


_PRF = """
WITH cells AS (SELECT quality AS l, toxic AS p, count(*) AS n FROM labels GROUP BY ALL),
 k AS (SELECT l AS c FROM cells UNION SELECT p FROM cells),
 per AS (SELECT k.c,
   coalesce((SELECT sum(n) FROM cells WHERE l = k.c), 0) AS support,
   coalesce((SELECT sum(n) FROM cells WHERE p = k.c), 0) AS predicted,
   coalesce((SELECT sum(n) FROM cells WHERE l = k.c AND p = k.c), 0) AS tp FROM k),
 pr AS (SELECT *, CASE WHEN predicted > 0 THEN tp / predicted ELSE 0.0 END AS pp,
   CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS rr FROM per),
 f AS (SELECT *, CASE WHEN pp + rr > 0 THEN 2 * pp * rr / (pp + rr) ELSE 0.0 END AS ff FROM pr)
SELECT sum(pp * support) / sum(support) AS precision, sum(rr * support) / sum(support) AS recall,
  sum(ff * support) / sum(support) AS f1 FROM f
"""


@query("weighted_prf", _PRF, round_cols=["precision", "recall", "f1"])
def q_weighted_prf(spark, sf):
    return A.weighted_prf(table(spark, sf, "labels"), "quality", "toxic")


@query("best_model",
       "SELECT task, best, best_accuracy FROM (SELECT task, model AS best, accuracy AS best_accuracy, "
       "row_number() OVER (PARTITION BY task ORDER BY accuracy DESC, model) AS rn FROM model_runs "
       "WHERE accuracy IS NOT NULL) t WHERE rn = 1", views=["model_runs"])
def q_best_model(spark, sf):
    return A.best_by(model_runs(spark, sf), "task", "accuracy", "model", highest=True, out="best")


@query("fastest_model",
       "SELECT task, fastest, fastest_train_time FROM (SELECT task, model AS fastest, "
       "train_time AS fastest_train_time, row_number() OVER (PARTITION BY task ORDER BY train_time, model) AS rn "
       "FROM model_runs WHERE train_time IS NOT NULL) t WHERE rn = 1", views=["model_runs"])
def q_fastest_model(spark, sf):
    return A.best_by(model_runs(spark, sf), "task", "train_time", "model", highest=False, out="fastest")


_HIST = """
WITH x AS (SELECT energy_param AS v FROM processed WHERE isfinite(energy_param)),
 s AS (SELECT min(v) AS lo, max(v) AS hi, count(v) AS n FROM x),
 w AS (SELECT lo, n, CASE WHEN hi > lo THEN (hi - lo) / 50 ELSE 1.0 END AS width FROM s WHERE n > 0),
 b AS (SELECT least(CAST(floor((v - w.lo) / w.width) AS INTEGER), 49) AS bin FROM x, w),
 c AS (SELECT bin, count(*) AS count FROM b GROUP BY bin),
 r AS (SELECT CAST(unnest(range(50)) AS INTEGER) AS bin)
SELECT r.bin, w.lo + r.bin * w.width AS lo, w.lo + (r.bin + 1) * w.width AS hi, coalesce(c.count, 0) AS count,
  coalesce(c.count, 0) / (w.n * w.width) AS density FROM r CROSS JOIN w LEFT JOIN c ON r.bin = c.bin
"""


@query("histogram", _HIST, views=["processed"], round_cols=["lo", "hi", "density"])
def q_histogram(spark, sf):
    return A.histogram(processed(spark, sf), "energy_param", 50)


@query("total_time", "SELECT approach, sum(train_time) AS total_time FROM model_runs GROUP BY approach",
       views=["model_runs"], round_cols=["total_time"])
def q_total_time(spark, sf):
    return A.total_by(model_runs(spark, sf), "approach", "train_time", "total_time")
