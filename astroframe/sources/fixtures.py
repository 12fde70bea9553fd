"""Fixture views with the reference's schemas, derived from the driver's tables.

Each view is written once as portable SQL with ``{table}`` placeholders:
Spark binds DataFrames through ``spark.sql(query, **frames)``; the DuckDB
oracle uses the same text as a CTE over its pre-registered views.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from astroframe.sources.tables import table

BODIES_SQL = """
SELECT CAST(1000000 + k AS STRING) AS spkid, concat('Body_', CAST(k AS STRING)) AS full_name,
 CASE WHEN k % 50 = 7 THEN 'iso' WHEN c IN (13,14) THEN 'c' ELSE 'a' END AS kind,
 CASE WHEN c < 7 THEN 'MBA' WHEN c = 7 THEN 'MCA' WHEN c = 8 THEN 'OMB' WHEN c = 9 THEN 'IMB' WHEN c = 10 THEN 'APO'
      WHEN c = 11 THEN 'AMO' WHEN c = 12 THEN 'ATE' WHEN c = 13 THEN 'JFc' WHEN c = 14 THEN 'HTC' WHEN c = 15 THEN 'TNO'
      WHEN c = 16 THEN 'CEN' WHEN c = 17 THEN 'TJN' WHEN c = 18 THEN 'HYP' ELSE NULL END AS class,
 CASE WHEN c IN (10,11,12) THEN 'Y' ELSE 'N' END AS neo,
 CASE WHEN c = 10 AND r2 < 50 THEN 'Y' ELSE 'N' END AS pha,
 e, a, i, om, w, a * (1 - e) AS q, CASE WHEN e < 1 THEN a * (1 + e) END AS ad,
 CASE WHEN e < 1 AND a > 0 THEN a * sqrt(a) END AS per_y, 2460000.5e0 AS epoch,
 CASE WHEN k % 31 = 0 THEN NULL WHEN k % 67 = 0 THEN -7.5e0 WHEN k % 71 = 0 THEN 40.25e0 ELSE 5.0e0 + r1 / 50.0e0 END AS H,
 CASE WHEN k % 3 = 0 THEN NULL WHEN k % 41 = 0 THEN 0.0e0 ELSE r2 / 10.0e0 + 0.5e0 END AS diameter,
 CASE WHEN k % 4 = 0 THEN NULL ELSE r1 / 2000.0e0 + 0.01e0 END AS albedo,
 CASE WHEN k % 29 = 0 THEN NULL ELSE r2 / 500.0e0 END AS moid
FROM (SELECT k, c, r1, r2,
   CASE WHEN k % 97 = 0 THEN NULL WHEN k % 89 = 0 THEN -0.1e0 WHEN c = 18 THEN 1.01e0 + r1 / 400.0e0 WHEN c IN (13,14) THEN 0.4e0 + r1 / 2000.0e0 ELSE r1 / 1500.0e0 END AS e,
   CASE WHEN k % 101 = 0 THEN NULL WHEN k % 211 = 0 THEN 0.0e0 WHEN c = 18 THEN -(0.5e0 + r2 / 400.0e0) WHEN c < 10 THEN 2.0e0 + r2 / 700.0e0 WHEN c < 13 THEN 0.5e0 + r2 / 700.0e0 WHEN c < 15 THEN 3.0e0 + r2 / 20.0e0 WHEN c = 15 THEN 30.0e0 + r2 / 15.0e0 ELSE 5.2e0 + r2 / 40.0e0 END AS a,
   CASE WHEN k % 53 = 0 THEN NULL WHEN k % 59 = 0 THEN 195.5e0 WHEN k % 61 = 0 THEN -3.5e0 ELSE p % 90 END AS i,
   CAST(r3 AS DOUBLE) AS om, CAST((r3 * 7) % 360 AS DOUBLE) AS w
 FROM (SELECT o_orderkey AS k, o_orderkey % 20 AS c, (o_orderkey * 7919) % 1000 AS r1, (o_orderkey * 104729 + o_custkey) % 1000 AS r2, o_custkey % 360 AS r3, CAST(floor(o_totalprice) AS BIGINT) % 90 + 0.25e0 AS p FROM {orders}) t0) t1
"""

_GALAXIES_TEMPLATE = """
SELECT vec_id AS gal_id, label,
 CAST({e1} AS DOUBLE) AS u_g, CAST({e2} AS DOUBLE) AS g_r,
 CAST({e3} AS DOUBLE) AS r_i, CAST({e4} AS DOUBLE) AS i_z,
 CASE WHEN vec_id % 37 = 0 THEN 0e0 ELSE ((vec_id * 7919) % 1000) / 900e0 END AS redshift
FROM {{embeddings}}
"""
GALAXIES_SQL_SPARK = _GALAXIES_TEMPLATE.format(
    **{f"e{n}": f"element_at(embedding, {n})" for n in range(1, 5)})
GALAXIES_SQL_DUCKDB = _GALAXIES_TEMPLATE.format(
    **{f"e{n}": f"embedding[{n}]" for n in range(1, 5)})

EPHEMERIS_SQL = """
SELECT concat('Obj_', CAST(user_id AS STRING)) AS object, ts AS datetime, value AS r, event_type FROM {events}
"""

MODEL_RUNS_SQL = """
SELECT CASE c_nationkey % 3 WHEN 0 THEN 'object_classification' WHEN 1 THEN 'anomaly_detection' ELSE 'spectral_classification' END AS task,
 CASE WHEN c_custkey % 2 = 0 THEN 'ML' ELSE 'DL' END AS approach, c_mktsegment AS model,
 CASE WHEN c_nationkey % 3 = 1 THEN NULL ELSE round(avg(abs(c_acctbal)) / 10000e0, 6) END AS accuracy,
 CASE WHEN c_nationkey % 3 = 1 THEN NULL ELSE round(avg(abs(c_acctbal)) / 10500e0, 6) END AS f1,
 round(sum(c_custkey) / 1000e0, 3) AS train_time, count(*) AS n_anomalies
FROM {customer}
GROUP BY c_nationkey % 3, CASE WHEN c_custkey % 2 = 0 THEN 'ML' ELSE 'DL' END, c_mktsegment
"""


def bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw body catalogue (19 columns, key ``spkid``) derived from ``orders``."""
    return spark.sql(BODIES_SQL, orders=table(spark, sf_dir, "orders"))


def galaxies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Galaxy colours (4 colour indices + redshift) derived from ``embeddings``."""
    return spark.sql(GALAXIES_SQL_SPARK, embeddings=table(spark, sf_dir, "embeddings"))


def ephemeris(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-object time series (object, datetime, r) derived from ``events``."""
    return spark.sql(EPHEMERIS_SQL, events=table(spark, sf_dir, "events"))


def model_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per (task, approach, model) with metrics, derived from ``customer``."""
    return spark.sql(MODEL_RUNS_SQL, customer=table(spark, sf_dir, "customer"))


def duckdb_cte(name: str) -> str:
    """The fixture's SQL as DuckDB text over the pre-registered views."""
    text = {
        "bodies": BODIES_SQL,
        "galaxies": GALAXIES_SQL_DUCKDB,
        "ephemeris": EPHEMERIS_SQL,
        "model_runs": MODEL_RUNS_SQL,
    }[name]
    for t in ("orders", "embeddings", "events", "customer"):
        text = text.replace("{" + t + "}", t)
    return text
