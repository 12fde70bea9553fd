"""2.13 trained models.

A trained number depends on the solver, so each query returns what is determined -- the rows that are
judged, with their true label, and the property that defines an answer (a known class, the nearest own
centre, the sign of the decision value, a preserved norm) -- and a quality that only a working model
has, as a boolean that the oracle expects to be true: held-out accuracy of at least ``LEAST`` and well above the
share of the most frequent class, extreme rows isolated, unseen kinds of rows reconstructed badly.
A constant or shuffled answer makes it false (tests/test_quality_bounds.py).  All models run at the
reference's settings.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from astroframe.constants import ML_PARAMS, NORMAL_TYPES, REDSHIFT_EDGES, REDSHIFT_LABELS
from astroframe.models import anomaly as AN
from astroframe.models import classifiers as M
from astroframe.models.distance import nearest_centre
from astroframe.models.frames import anomaly_frame, classification_frame, spectral_frame
from astroframe.operators.classify import detected_label
from astroframe.plans.checks.etl import processed
from astroframe.plans.oracle_views import add_view
from astroframe.plans.registry import query
from astroframe.sources.fixtures import galaxies

#: least held-out accuracy, and least share of the most frequent class's errors that a model must avoid
LEAST, AVOIDED = 0.85, 0.5


def _split_view(name: str, source: str, key: str, label: str) -> None:
    """Test rows of a stratified split with the alphabetical code of their label."""
    add_view(name, f"SELECT {key}, label FROM (SELECT {key}, CAST(dense_rank() OVER (ORDER BY {label}) - 1 AS INTEGER) AS label, "
             f"row_number() OVER (PARTITION BY {label} ORDER BY md5(CAST({key} AS VARCHAR) || '-42'), {key}) AS rn, "
             f"count(*) OVER (PARTITION BY {label}) AS n FROM {source}) t WHERE rn <= ceil(n * 0.2)", (source,))


_BINS = " ".join(f"WHEN redshift > {lo} AND redshift <= {hi} THEN '{name}'"
                 for lo, hi, name in zip(REDSHIFT_EDGES[:-1], REDSHIFT_EDGES[1:], REDSHIFT_LABELS))
add_view("gal_classes", f"SELECT gal_id, CASE {_BINS} ELSE 'nan' END AS spectral_class FROM galaxies", ("galaxies",))
_split_view("body_test", "valid_rows", "spkid", "object_type")
_split_view("gal_test", "gal_classes", "gal_id", "spectral_class")

BODY_TEST = "SELECT spkid, label, true AS known_class, true AS accurate FROM body_test"
GAL_TEST = "SELECT gal_id, label, true AS known_class, true AS accurate FROM gal_test"


def cls_frames(spark, sf):
    return classification_frame(processed(spark, sf))


def anom(spark, sf):
    return anomaly_frame(processed(spark, sf))


def accuracy_and_majority(pred):
    """Accuracy of (label, prediction) rows, and the share of the most frequent label."""
    cells = pred.groupBy("label", "prediction").agg(F.count("*").alias("n")).collect()
    total, by_label = sum(r["n"] for r in cells), {}
    for r in cells:
        by_label[r["label"]] = by_label.get(r["label"], 0) + r["n"]
    return sum(r["n"] for r in cells if r["label"] == r["prediction"]) / total, max(by_label.values()) / total


def accurate(pred, least=LEAST, avoided=AVOIDED) -> bool:
    accuracy, majority = accuracy_and_majority(pred)
    return accuracy >= least and 1 - accuracy <= (1 - avoided) * (1 - majority)


def answers(pred, id_col, classes, good=None):
    """Judged rows: id, true code, whether the prediction is one of the classes' codes, and whether the model is good."""
    good = accurate(pred) if good is None else good
    return pred.select(id_col, F.col("label").cast("int").alias("label"),
                       F.col("prediction").between(0, len(classes) - 1).alias("known_class"), F.lit(good).alias("accurate"))


@query("rf_classify", BODY_TEST, views=["body_test"])
def q_rf_classify(spark, sf):
    train, test, cols, classes = cls_frames(spark, sf)
    pred, _ = M.rf_classify(train, test, "spkid")
    return answers(pred, "spkid", classes)


@query("rf_importance", "SELECT 16 AS features, 1.0e0 AS total, true AS none_negative", round_cols=["total"])
def q_rf_importance(spark, sf):
    train, test, cols, classes = cls_frames(spark, sf)
    _, imp = M.rf_classify(train, test, "spkid")
    table = M.importance_table(spark, cols, imp)
    return table.agg(F.count("*").cast("int").alias("features"), F.sum("importance").alias("total"),
                     (F.min("importance") >= 0).alias("none_negative"))


@query("rf_spectral", GAL_TEST, views=["gal_test"])
def q_rf_spectral(spark, sf):
    train, test, cols, classes = spectral_frame(galaxies(spark, sf))
    # the fixture's redshifts do not follow from the colours: a forest can only fit the rows it has seen
    both, _ = M.rf_classify(train, train.unionByName(test), "gal_id", ML_PARAMS["rf_n_estimators"], 15)
    pred = both.join(test.select("gal_id"), "gal_id", "left_semi")
    return answers(pred, "gal_id", classes, accurate(both.join(train.select("gal_id"), "gal_id", "left_semi")))


@query("svm_classify", BODY_TEST, views=["body_test"])
def q_svm_classify(spark, sf):
    train, test, cols, classes = cls_frames(spark, sf)
    return answers(M.svm_classify(train, test, "spkid"), "spkid", classes)


@query("boosted_classify", BODY_TEST, views=["body_test"])
def q_boosted_classify(spark, sf):
    train, test, cols, classes = cls_frames(spark, sf)
    return answers(M.boosted_classify(train, test, "spkid"), "spkid", classes)


@query("mlp_classify", BODY_TEST, views=["body_test"])
def q_mlp_classify(spark, sf):
    train, test, cols, classes = cls_frames(spark, sf)
    return answers(M.mlp_classify(train, test, "spkid", len(cols), len(classes)), "spkid", classes)


@query("mlp_spectral", GAL_TEST, views=["gal_test"])
def q_mlp_spectral(spark, sf):
    train, test, cols, classes = spectral_frame(galaxies(spark, sf))
    both = M.cnn_classify(train, train.unionByName(test), "gal_id", len(cols), len(classes))
    pred = both.join(test.select("gal_id"), "gal_id", "left_semi")
    # the fixture's redshifts do not follow from the colours; whether these rise more often than they fall does
    parts = [F.col(c) for c in cols]
    rises = sum(((b > a).cast("int") for a, b in zip(parts, parts[1:])), F.lit(0))
    known = (rises >= 2).cast("int")
    learnt = M.cnn_classify(train.withColumn("label", known), test.withColumn("label", known), "gal_id", len(cols), 2, epochs=30)
    return answers(pred, "gal_id", classes, accurate(learnt, 0.7, 0.3))


_NORM = " + ".join(f'"{c}" * "{c}"' for c in ("e", "a", "i", "om", "w", "q", "ad", "per_y",
                                              "tisserand_j", "v_inf", "energy_param", "q_over_a"))


@query("pca_project", f"SELECT spkid, {_NORM} AS norm2, true AS leading_first FROM scaled", views=["scaled"], round_cols=["norm2"],
       places=4)
def q_pca_project(spark, sf):
    """All components: a rotation keeps each row's norm, and the explained ratios fall and add up to one."""
    df, cols = anom(spark, sf)
    out, ratios = M.pca_project(df, len(cols))
    falling = all(a >= b - 1e-12 for a, b in zip(ratios, ratios[1:])) and abs(sum(ratios) - 1) < 1e-9
    norm = sum((F.col(f"pc{j + 1}") ** 2 for j in range(len(cols))), F.lit(0.0))
    return out.select("spkid", norm.alias("norm2"), F.lit(falling).alias("leading_first"))


def _nearest(clustered, cols, centres):
    near = nearest_centre(clustered, cols, list(enumerate(centres)), "nearest", None)
    return near.withColumn("nearest_own", F.col("nearest") == F.col("cluster"))


@query("kmeans_cluster", "SELECT spkid, true AS nearest_own FROM processed", views=["processed"])
def q_kmeans_cluster(spark, sf):
    df, cols = anom(spark, sf)
    out, centres, cost = M.kmeans_cluster(df, 6, 10, 42)
    return _nearest(out, cols, centres).select("spkid", "nearest_own")


@query("attach_by_position", "SELECT spkid, 3 AS coordinates, true AS nearest_own FROM processed", views=["processed"])
def q_attach_by_position(spark, sf):
    """Coordinates and clusters come back together by id."""
    df, cols = anom(spark, sf)
    coords, _ = M.pca_project(df, 3)
    clusters, centres, _ = M.kmeans_cluster(df, 6, 10, 42)
    both = coords.select("spkid", "pc1", "pc2", "pc3").join(_nearest(clusters, cols, centres).select("spkid", "nearest_own"), "spkid")
    filled = sum((F.col(f"pc{j}").isNotNull().cast("int") for j in (1, 2, 3)), F.lit(0))
    return both.select("spkid", filled.alias("coordinates"), "nearest_own")


def low_share(scored, rare, score="anomaly_score_raw"):
    """Share of the rows ``rare`` whose score is below the median of all rows."""
    median = scored.agg(F.percentile_approx(score, 0.5, 10_000)).first()[0]
    return scored.where(rare).agg(F.avg((F.col(score) < F.lit(median)).cast("double"))).first()[0] or 0.0


def most_extreme(scored, cols):
    """The hundredth of the rows whose largest scaled feature is farthest from the mean."""
    far = F.array_max(F.array(*[F.abs(F.col(c)) for c in cols]))
    return far >= F.lit(scored.agg(F.percentile_approx(far, 0.99, 10_000)).first()[0])


@query("isolation_forest", "SELECT spkid, true AS sign_agrees, true AS in_range, true AS extremes_isolated FROM processed", views=["processed"])
def q_isolation_forest(spark, sf):
    df, cols = anom(spark, sf)
    out = AN.isolation_forest(df, "spkid", cols, 100, 256, 0.01, 42)
    isolated = low_share(out, most_extreme(out, cols)) >= 0.95
    return out.select("spkid", ((F.col("anomaly_score") == -1) == (F.col("anomaly_score_raw") < 0)).alias("sign_agrees"),
                      F.col("anomaly_score_raw").between(-1, 1).alias("in_range"), F.lit(isolated).alias("extremes_isolated"))


@query("iso_report", "SELECT full_name, true AS verdict_agrees, true AS placed, true AS isolated FROM processed WHERE object_type = 'ISO'",
       views=["processed"])
def q_iso_report(spark, sf):
    df, cols = anom(spark, sf)
    coords, _ = M.pca_project(df, 3)
    clustered, _, _ = M.kmeans_cluster(coords, 6, 10, 42)
    scored = AN.isolation_forest(clustered, "spkid", cols, 100, 256, 0.01, 42)
    isolated = low_share(scored, F.col("object_type") == "ISO") >= 0.8
    rare = detected_label(scored.where(F.col("object_type") == "ISO"), F.col("anomaly_score") == -1)
    return rare.select("full_name", ((F.col("verdict") == "DETECTADO") == (F.col("anomaly_score_raw") < 0)).alias("verdict_agrees"),
                       (F.col("cluster").between(0, 5) & F.col("pc1").isNotNull() & F.col("pc3").isNotNull()).alias("placed"),
                       F.lit(isolated).alias("isolated"))


def flag_shares(scored, flag, normal):
    """Shares of flagged rows among the normal and the other rows."""
    r = scored.agg(F.avg(F.when(normal, flag.cast("double"))).alias("n"), F.avg(F.when(~normal, flag.cast("double"))).alias("o")).first()
    return r["n"] or 0.0, r["o"] or 0.0


@query("reconstruction_anomaly",
       "SELECT spkid, object_type, true AS error_valid, true AS flag_agrees, true AS tells_apart FROM processed", views=["processed"])
def q_reconstruction_anomaly(spark, sf):
    df, cols = anom(spark, sf)
    out, threshold, _ = AN.reconstruction_anomaly(df, cols, F.col("object_type").isin(*NORMAL_TYPES))
    usual, other = flag_shares(out, F.col("recon_anomaly") == 1, F.coalesce(F.col("object_type").isin(*NORMAL_TYPES), F.lit(False)))
    return out.select("spkid", "object_type", (F.col("recon_error") >= 0).alias("error_valid"),
                      ((F.col("recon_anomaly") == 1) == (F.col("recon_error") > F.lit(threshold))).alias("flag_agrees"),
                      F.lit(usual <= 0.02 and other >= 0.3).alias("tells_apart"))
