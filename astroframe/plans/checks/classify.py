"""2.4 conditional mapping / binning / encoding."""

from __future__ import annotations

from pyspark.sql import functions as F

from astroframe.constants import OBJECT_CLASSES, REDSHIFT_EDGES, REDSHIFT_LABELS
from astroframe.operators import classify as K
from astroframe.plans.checks.etl import processed
from astroframe.plans.oracle_views import _class_case
from astroframe.plans.registry import query
from astroframe.sources.fixtures import bodies, ephemeris, galaxies
from astroframe.sources.tables import table

_DIM_VALUES = ", ".join(f"('{k}', '{v}')" for k, v in OBJECT_CLASSES.items())
_BINS = " ".join(f"WHEN redshift > {lo} AND redshift <= {hi} THEN '{lab}'"
                 for lo, hi, lab in zip(REDSHIFT_EDGES[:-1], REDSHIFT_EDGES[1:], REDSHIFT_LABELS))


@query("map_class", f"SELECT spkid, class, {_class_case('class')} AS object_type FROM bodies", views=["bodies"])
def q_map_class(spark, sf):
    return K.map_class(bodies(spark, sf)).select("spkid", "class", "object_type")


@query("override_type",
       f"SELECT spkid, CASE WHEN kind = 'iso' THEN 'ISO' WHEN e > 1.0 THEN 'ISO' ELSE {_class_case('class')} END "
       "AS object_type FROM bodies", views=["bodies"])
def q_override_type(spark, sf):
    return K.override_type(K.map_class(bodies(spark, sf))).select("spkid", "object_type")


@query("label_dim",
       f"SELECT p.spkid, p.object_type, d.description FROM processed p LEFT JOIN (VALUES {_DIM_VALUES}) "
       "AS d(object_type, description) ON p.object_type = d.object_type", views=["processed"])
def q_label_dim(spark, sf):
    dim = K.class_dimension(spark)
    return K.label_dim(processed(spark, sf).select("spkid", "object_type"), dim, "object_type") \
        .select("spkid", "object_type", "description")


@query("cut_bins", f"SELECT gal_id, redshift, CASE {_BINS} ELSE 'nan' END AS spectral_class FROM galaxies",
       views=["galaxies"])
def q_cut_bins(spark, sf):
    g = galaxies(spark, sf)
    return K.cut_bins(g, "redshift", REDSHIFT_EDGES, REDSHIFT_LABELS, "spectral_class") \
        .select("gal_id", "redshift", "spectral_class")


@query("phase_label",
       "WITH b AS (SELECT object, min(datetime) AS t0, max(datetime) AS t1 FROM ephemeris GROUP BY object) "
       "SELECT e.object, e.datetime, CASE WHEN p < 0.4 THEN 'Aproximacion' WHEN p < 0.6 THEN 'PERIHELIO' "
       "ELSE 'Salida' END AS phase FROM (SELECT e.object, e.datetime, CASE WHEN b.t1 > b.t0 THEN "
       "CAST(date_diff('microsecond', b.t0, e.datetime) AS DOUBLE) / CAST(date_diff('microsecond', b.t0, b.t1) "
       "AS DOUBLE) ELSE 0.0e0 END AS p FROM ephemeris e JOIN b ON e.object = b.object) e",
       views=["ephemeris"])
def q_phase_label(spark, sf):
    e = ephemeris(spark, sf)
    span = e.groupBy("object").agg(F.min("datetime").alias("t0"), F.max("datetime").alias("t1"))
    us = lambda a, b: F.timestamp_diff("MICROSECOND", F.col(a), F.col(b)).cast("double")
    prog = F.when(F.col("t1") > F.col("t0"), us("t0", "datetime") / us("t0", "t1")).otherwise(F.lit(0.0))
    e = e.join(span, "object").withColumn("progress", prog)
    return K.phase_label(e, "progress").select("object", "datetime", "phase")


@query("detected_label",
       "SELECT spkid, CASE WHEN object_type = 'ISO' AND e > 1 THEN 'DETECTADO' ELSE 'NO detectado' END AS verdict "
       "FROM processed", views=["processed"])
def q_detected_label(spark, sf):
    p = processed(spark, sf)
    flag = F.coalesce((F.col("object_type") == "ISO") & (F.col("e") > 1), F.lit(False))
    return K.detected_label(p, flag).select("spkid", "verdict")


@query("label_encode",
       "SELECT spkid, object_type, CAST(dense_rank() OVER (ORDER BY object_type) - 1 AS INTEGER) AS label "
       "FROM processed WHERE object_type IS NOT NULL", views=["processed"])
def q_label_encode(spark, sf):
    p = processed(spark, sf).where(F.col("object_type").isNotNull()).select("spkid", "object_type")
    return K.label_encode(p, "object_type").select("spkid", "object_type", "label")


@query("argmax_label",
       "SELECT vec_id, label, CAST(list_position(embedding, list_max(embedding)) - 1 AS INTEGER) AS pred "
       "FROM embeddings")
def q_argmax_label(spark, sf):
    return K.argmax_label(table(spark, sf, "embeddings"), "embedding").select("vec_id", "label", "pred")
