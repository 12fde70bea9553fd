"""2.5 joins and 2.12 trajectory tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from astroframe.operators import joins as J
from astroframe.operators import trajectory as T
from astroframe.plans.checks.etl import processed
from astroframe.plans.registry import query
from astroframe.sources.tables import table

XYZ = ["x", "y", "z"]
N_PATH = 500


def _lin(lo: str, hi: str, n: int) -> str:
    return f"CASE WHEN j = {n - 1} THEN {hi} ELSE {lo} + j * (({hi} - ({lo})) / {float(n - 1)}) END"


_HYP = f"""
WITH h AS (SELECT spkid, e, q, i, acos(-1.0e0 / e) - 0.1e0 AS nu_max FROM processed WHERE e > 1.0),
 p AS (SELECT spkid, e, q, i, j, {_lin('-nu_max', 'nu_max', N_PATH)} AS nu FROM h CROSS JOIN (SELECT CAST(range AS INTEGER) AS j FROM range({N_PATH})) AS t),
 r AS (SELECT *, q / (e - 1.0e0) * (e * e - 1.0e0) / (1.0e0 + e * cos(nu)) AS r FROM p)
"""


def hyp(spark, sf):
    return T.hyperbolic_path(processed(spark, sf), n=N_PATH)


@query("semi_valid_classes",
       "SELECT spkid, object_type FROM processed WHERE object_type IN "
       "(SELECT object_type FROM processed WHERE object_type IS NOT NULL GROUP BY object_type HAVING count(*) >= 50)",
       views=["processed"])
def q_semi_valid(spark, sf):
    return J.semi_valid_classes(processed(spark, sf), "object_type", 50).select("spkid", "object_type")


@query("dim_join",
       "SELECT c_custkey, n_name, r_name FROM customer JOIN nation ON c_nationkey = n_nationkey "
       "JOIN region ON n_regionkey = r_regionkey")
def q_dim_join(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", F.col("c_nationkey").alias("n_nationkey"))
    n = table(spark, sf, "nation").select("n_nationkey", "n_name", F.col("n_regionkey").alias("r_regionkey"))
    r = table(spark, sf, "region").select("r_regionkey", "r_name")
    return J.dim_join(J.dim_join(c, n, "n_nationkey", "inner"), r, "r_regionkey", "inner") \
        .select("c_custkey", "n_name", "r_name")


@query("scalar_threshold",
       "SELECT spkid, energy_param FROM processed WHERE energy_param > "
       "(SELECT avg(energy_param) FROM processed WHERE object_type IN ('MBA', 'NEO'))",
       views=["processed"], round_cols=["energy_param"])
def q_scalar_threshold(spark, sf):
    p = processed(spark, sf)
    return J.scalar_threshold(p, "energy_param", F.avg("energy_param"),
                              F.col("object_type").isin("MBA", "NEO")).select("spkid", "energy_param")


@query("frame_sample",
       _HYP + " SELECT r.spkid, f.frame, r.j, r.r FROM r JOIN (SELECT DISTINCT spkid FROM h) k ON true "
       "JOIN (SELECT CAST(range AS INTEGER) AS frame FROM range(60)) AS f ON true "
       f"WHERE r.spkid = k.spkid AND r.j = CAST(floor(f.frame / 60.0e0 * {N_PATH - 1}) AS INTEGER)",
       views=["processed"], round_cols=["r"])
def q_frame_sample(spark, sf):
    path = hyp(spark, sf).select("spkid", "j", "r")
    return J.frame_sample(path, "spkid", "j", N_PATH, 60).select("spkid", "frame", "j", "r")


@query("hyperbolic_path",
       _HYP + " SELECT spkid, j, r * cos(nu) AS x, r * sin(nu) * cos(radians(i)) AS y, "
       "r * sin(nu) * sin(radians(i)) AS z FROM r", views=["processed"], round_cols=XYZ)
def q_hyperbolic_path(spark, sf):
    return hyp(spark, sf).select("spkid", "j", *XYZ)


_HYP3 = f"""
WITH h AS (SELECT spkid, e, q, i, om, w, acos(-1.0e0 / e) * 0.95e0 AS vmax FROM processed WHERE e > 1.0),
 p AS (SELECT *, {_lin('-vmax', 'vmax', N_PATH)} AS nu FROM h CROSS JOIN (SELECT CAST(range AS INTEGER) AS j FROM range({N_PATH})) AS t),
 r AS (SELECT *, q * (1.0e0 + e) / (1.0e0 + e * cos(nu)) AS r FROM p),
 o AS (SELECT *, r * cos(nu) AS xo, r * sin(nu) AS yo FROM r)
SELECT spkid, j,
 (cos(om) * cos(w) - sin(om) * sin(w) * cos(i)) * xo + (-cos(om) * sin(w) - sin(om) * cos(w) * cos(i)) * yo AS x,
 (sin(om) * cos(w) + cos(om) * sin(w) * cos(i)) * xo + (-sin(om) * sin(w) + cos(om) * cos(w) * cos(i)) * yo AS y,
 (sin(w) * sin(i)) * xo + (cos(w) * sin(i)) * yo AS z FROM o
"""


@query("hyperbolic_path_3d", _HYP3, views=["processed"], round_cols=XYZ)
def q_hyperbolic_path_3d(spark, sf):
    return T.hyperbolic_path_3d(processed(spark, sf), n=N_PATH).select("spkid", "j", *XYZ)


_POLAR = f"""
WITH p AS (SELECT spkid, e, a, i, j, {_lin('-pi() / 2', 'pi() / 2', 100)} AS theta
           FROM processed CROSS JOIN (SELECT CAST(range AS INTEGER) AS j FROM range(100)) AS t WHERE object_type = 'ISO'),
 r0 AS (SELECT *, abs(a) * (e * e - 1.0e0) / (1.0e0 + e * cos(theta)) AS r1 FROM p),
 r AS (SELECT *, CASE WHEN r1 > 50.0 THEN 50.0e0 WHEN r1 < 0 THEN 0.0e0 ELSE r1 END AS r FROM r0)
SELECT spkid, j, r * cos(theta) AS x, r * sin(theta) * cos(radians(i)) AS y, r * sin(theta) * sin(radians(i)) AS z
FROM r
"""


@query("polar_path", _POLAR, views=["processed"], round_cols=XYZ)
def q_polar_path(spark, sf):
    iso = processed(spark, sf).where(F.col("object_type") == "ISO")
    return T.polar_path(iso, n=100).select("spkid", "j", *XYZ)


@query("circular_path",
       f"WITH t AS (SELECT object_type, avg(a) AS radius FROM processed WHERE a > 0 AND object_type IS NOT NULL "
       f"GROUP BY object_type), p AS (SELECT *, {_lin('0.0e0', '2 * pi()', 200)} AS theta FROM t "
       f"CROSS JOIN (SELECT CAST(range AS INTEGER) AS j FROM range(200)) AS s) SELECT object_type, j, radius * cos(theta) AS x, radius * sin(theta) AS y, "
       f"0.0e0 AS z FROM p", views=["processed"], round_cols=XYZ)
def q_circular_path(spark, sf):
    t = processed(spark, sf).where((F.col("a") > 0) & F.col("object_type").isNotNull()) \
        .groupBy("object_type").agg(F.avg("a").alias("radius"))
    return T.circular_path(t, "radius", 200).select("object_type", "j", *XYZ)


@query("radius_progress",
       _HYP + f" SELECT spkid, j, sqrt(pow(r * cos(nu), 2) + pow(r * sin(nu) * cos(radians(i)), 2) + "
       f"pow(r * sin(nu) * sin(radians(i)), 2)) AS dist, j / {float(N_PATH)} * 100.0e0 AS progress FROM r",
       views=["processed"], round_cols=["dist", "progress"])
def q_radius_progress(spark, sf):
    return T.radius_progress(hyp(spark, sf), N_PATH).select("spkid", "j", "dist", "progress")


@query("unit_vector_offset",
       _HYP + ", c AS (SELECT spkid, j, r * cos(nu) AS x, r * sin(nu) * cos(radians(i)) AS y, "
       "r * sin(nu) * sin(radians(i)) AS z FROM r), d AS (SELECT *, sqrt(pow(x, 2) + pow(y, 2) + pow(z, 2)) AS d FROM c) "
       "SELECT spkid, j, CASE WHEN d > 0 THEN x + x / d * 1.5e0 END AS tail_x, "
       "CASE WHEN d > 0 THEN y + y / d * 1.5e0 END AS tail_y, CASE WHEN d > 0 THEN z + z / d * 1.5e0 END AS tail_z "
       "FROM d", views=["processed"], round_cols=["tail_x", "tail_y", "tail_z"])
def q_unit_vector_offset(spark, sf):
    return T.unit_vector_offset(hyp(spark, sf), 1.5).select("spkid", "j", "tail_x", "tail_y", "tail_z")
