"""2.13 model operators with an exact SQL form (preprocessing, distances, metrics)."""

from __future__ import annotations

from pyspark.sql import functions as F

from astroframe.constants import FEATURES_ALL, FEATURES_ENGINEERED, SDSS_FEATURES, SILHOUETTE_SAMPLE
from astroframe.models import distance as D
from astroframe.models import prep as P
from astroframe.models.frames import ANOMALY_FEATURES
from astroframe.operators import aggregate as A
from astroframe.operators.sampling import cap_rows
from astroframe.plans.checks.aggregate import _PRF
from astroframe.plans.checks.etl import processed
from astroframe.plans.oracle_views import add_view
from astroframe.plans.registry import query
from astroframe.session import stored
from astroframe.sources.fixtures import galaxies
from astroframe.sources.tables import table

FEATS = FEATURES_ALL + FEATURES_ENGINEERED


def _q(c):
    return f'"{c}"'


add_view("imputed", "SELECT spkid, object_type, " + ", ".join(
    f"coalesce({_q(c)}, (SELECT median({_q(c)}) FROM processed)) AS {_q(c)}" for c in FEATS) + " FROM processed",
    ("processed",))
add_view("scaled", "SELECT spkid, object_type, " + ", ".join(
    f"({_q(c)} - (SELECT avg({_q(c)}) FROM imputed)) / (SELECT CASE WHEN coalesce(stddev_pop({_q(c)}), 0) = 0 "
    f"THEN 1.0e0 ELSE stddev_pop({_q(c)}) END FROM imputed) AS {_q(c)}" for c in FEATS) + " FROM imputed",
    ("imputed",))
add_view("gal_sample", "SELECT gal_id, label, u_g, g_r, r_i, i_z FROM (SELECT *, row_number() OVER "
         "(ORDER BY md5(CAST(gal_id AS VARCHAR) || '-42'), gal_id) AS rn FROM galaxies) t WHERE rn <= 10000",
         ("galaxies",))
_DIST = " + ".join(f"(a.{c} - b.{c}) * (a.{c} - b.{c})" for c in SDSS_FEATURES)
add_view("gal_pairs", f"SELECT a.gal_id, a.label AS own, b.label AS other, sqrt({_DIST}) AS dist "
         "FROM gal_sample a JOIN gal_sample b ON a.gal_id <> b.gal_id", ("gal_sample",))
add_view("gal_means", "SELECT k.gal_id, k.own, k.other, coalesce(m.n, 0) AS n, m.md FROM "
         "(SELECT s.gal_id, s.label AS own, c.label AS other FROM gal_sample s, "
         "(SELECT DISTINCT label FROM gal_sample) c) k LEFT JOIN "
         "(SELECT gal_id, other, count(*) AS n, avg(dist) AS md FROM gal_pairs GROUP BY ALL) m "
         "ON k.gal_id = m.gal_id AND k.other = m.other", ("gal_pairs",))


_VALID = ("SELECT * FROM processed WHERE object_type IN (SELECT object_type FROM processed WHERE object_type "
          "IS NOT NULL GROUP BY object_type HAVING count(*) >= 50)")
add_view("valid_rows", _VALID, ("processed",))
add_view("valid_imputed", "SELECT spkid, " + ", ".join(
    f"coalesce({_q(c)}, (SELECT median({_q(c)}) FROM valid_rows)) AS {_q(c)}" for c in FEATS) + " FROM valid_rows",
    ("valid_rows",))
add_view("valid_scaled", "SELECT spkid, " + ", ".join(
    f"({_q(c)} - (SELECT avg({_q(c)}) FROM valid_imputed)) / (SELECT CASE WHEN coalesce(stddev_pop({_q(c)}), 0) = 0 "
    f"THEN 1.0e0 ELSE stddev_pop({_q(c)}) END FROM valid_imputed) AS f{n}" for n, c in enumerate(FEATS))
    + " FROM valid_imputed", ("valid_imputed",))


def imputed(spark, sf):
    rows = stored(processed(spark, sf).select("spkid", "object_type", *FEATS), "features")  # read by each fit
    return P.impute_median(rows, FEATS)


def scaled(spark, sf):
    return P.standardize(imputed(spark, sf), FEATS)


def gal_sample(spark, sf):
    return cap_rows(galaxies(spark, sf).select("gal_id", "label", *SDSS_FEATURES), "gal_id", SILHOUETTE_SAMPLE, 42)


@query("impute_median", "SELECT * FROM imputed", views=["imputed"], round_cols=FEATS)
def q_impute_median(spark, sf):
    return imputed(spark, sf)


@query("standardize", "SELECT * FROM scaled", views=["scaled"], round_cols=FEATS)
def q_standardize(spark, sf):
    return scaled(spark, sf)


@query("covariance_matrix",
       " UNION ALL ".join(f"SELECT '{a}' AS col_i, '{b}' AS col_j, covar_pop({_q(a)}, {_q(b)}) AS cov FROM scaled"
                          for n, a in enumerate(ANOMALY_FEATURES) for b in ANOMALY_FEATURES[n:]),
       views=["scaled"], round_cols=["cov"])
def q_covariance_matrix(spark, sf):
    return A.covariance_matrix(scaled(spark, sf), ANOMALY_FEATURES)


_CENTRES = ("c AS (SELECT label AS cid, " + ", ".join(f"avg({c}) AS {c}" for c in SDSS_FEATURES)
            + " FROM galaxies GROUP BY label), d AS (SELECT g.gal_id, c.cid, sqrt("
            + " + ".join(f"(g.{c} - c.{c}) * (g.{c} - c.{c})" for c in SDSS_FEATURES)
            + ") AS dist FROM galaxies g, c)")


@query("kmeans_assign",
       f"WITH {_CENTRES} SELECT gal_id, cid AS cluster, dist FROM (SELECT *, row_number() OVER "
       "(PARTITION BY gal_id ORDER BY dist, cid) AS rn FROM d) t WHERE rn = 1",
       views=["galaxies"], round_cols=["dist"])
def q_kmeans_assign(spark, sf):
    g = galaxies(spark, sf)
    cen = g.groupBy("label").agg(*[F.avg(c).alias(c) for c in SDSS_FEATURES]).collect()
    centres = [(r["label"], [r[c] for c in SDSS_FEATURES]) for r in cen]
    return D.nearest_centre(g, SDSS_FEATURES, centres).select("gal_id", "cluster", "dist")


@query("pair_distance", "SELECT gal_id, other AS to_cluster, n AS n_partners, md AS mean_dist FROM gal_means",
       views=["gal_means"], round_cols=["mean_dist"])
def q_pair_distance(spark, sf):
    return D.cluster_mean_distances(gal_sample(spark, sf), "gal_id", SDSS_FEATURES, "label")


_SQ = " + ".join(f"(a.{c} - b.{c}) * (a.{c} - b.{c})" for c in SDSS_FEATURES)
add_view("gal_squares", f"SELECT a.gal_id, a.label AS own, b.label AS other, avg({_SQ}) AS md FROM galaxies a JOIN galaxies b "
         "ON a.gal_id <> b.gal_id GROUP BY a.gal_id, a.label, b.label", ("galaxies",))
_SILHOUETTE = ("SELECT avg(CASE WHEN a IS NULL OR b IS NULL THEN 0.0e0 ELSE (b - a) / greatest(a, b) END) AS silhouette "
               "FROM (SELECT gal_id, max(CASE WHEN other = own THEN md END) AS a, "
               "min(CASE WHEN other <> own THEN md END) AS b FROM {} GROUP BY gal_id) t")


@query("silhouette", _SILHOUETTE.format("gal_squares"), views=["gal_squares"], round_cols=["silhouette"])
def q_silhouette(spark, sf):
    return D.silhouette(galaxies(spark, sf), "gal_id", SDSS_FEATURES, "label")


@query("silhouette_sampled", _SILHOUETTE.format("gal_means"), views=["gal_means"], round_cols=["silhouette"])
def q_silhouette_sampled(spark, sf):
    return D.sampled_silhouette(gal_sample(spark, sf), "gal_id", SDSS_FEATURES, "label")


@query("evaluate_model",
       "SELECT a.accuracy, p.precision, p.recall, p.f1 FROM (SELECT avg(CASE WHEN quality = toxic THEN 1.0e0 "
       "ELSE 0.0e0 END) AS accuracy FROM labels) a, (" + _PRF + ") p",
       round_cols=["accuracy", "precision", "recall", "f1"])
def q_evaluate_model(spark, sf):
    from astroframe.models.evaluate import evaluate
    return evaluate(table(spark, sf, "labels"), "quality", "toxic")


@query("anomaly_flag",
       "SELECT spkid, q_over_a, CASE WHEN q_over_a < (SELECT quantile_cont(q_over_a, 0.01) FROM processed) "
       "THEN -1 ELSE 1 END AS anomaly_score FROM processed", views=["processed"], round_cols=["q_over_a"])
def q_anomaly_flag(spark, sf):
    from astroframe.models.anomaly import anomaly_flag
    p = processed(spark, sf).select("spkid", "q_over_a")
    return anomaly_flag(p, "q_over_a", 0.01)


@query("assemble_features", "SELECT * FROM valid_scaled", views=["valid_scaled"],
       round_cols=[f"f{n}" for n in range(len(FEATS))])
def q_assemble_features(spark, sf):
    from pyspark.ml.functions import vector_to_array

    from astroframe.models.frames import classification_frame

    train, test, cols, classes = classification_frame(processed(spark, sf))
    arr = vector_to_array("features")
    return train.unionByName(test).select("spkid", *[arr[n].alias(f"f{n}") for n in range(len(cols))])
