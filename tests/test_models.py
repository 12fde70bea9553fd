"""Invariants of the trained models (their numbers depend on the solver)."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def anomaly(spark):
    from astroframe.models.frames import anomaly_frame
    from astroframe.plans.checks.etl import processed

    return anomaly_frame(processed(spark, SF_SMALL))


def test_isolation_forest_scores_and_share(spark, anomaly):
    from astroframe.models.anomaly import fit_isolation_forest, isolation_forest, score_isolation_forest

    df, cols = anomaly
    nodes, psi = fit_isolation_forest(df, "spkid", cols, 20, 64, 42)
    assert nodes["tree"].nunique() == 20 and (nodes.groupby("tree").size() <= 2 * 64 - 1).all()
    s = score_isolation_forest(df, cols, nodes, psi).select("score_samples").toPandas()["score_samples"]
    assert ((s < 0) & (s > -1)).all()
    out = isolation_forest(df, "spkid", cols, 20, 64, 0.01, 42).toPandas()
    n = len(out)
    assert abs((out["anomaly_score"] == -1).sum() - 0.01 * n) <= 1 + 0.01 * n
    assert set(out["anomaly_score"]) <= {-1, 1}


def test_isolation_forest_flags_planted_outlier(spark):
    from astroframe.models.anomaly import isolation_forest

    rng = np.random.default_rng(0)
    x = rng.normal(size=(2000, 3))
    x[7] = [12.0, -12.0, 12.0]
    pdf = pd.DataFrame(x, columns=["a", "b", "c"]).assign(id=np.arange(2000))
    out = isolation_forest(spark.createDataFrame(pdf), "id", ["a", "b", "c"], 50, 128, 0.01, 1).toPandas()
    assert out.set_index("id").loc[7, "anomaly_score"] == -1


def test_kmeans_rows_nearest_own_centre(spark, anomaly):
    from astroframe.models.classifiers import kmeans_cluster

    df, cols = anomaly
    out, centres, cost = kmeans_cluster(df, 4, 2, 42)
    pdf = out.select("cluster", *cols).toPandas()
    x = pdf[cols].to_numpy()
    d = ((x[:, None, :] - np.array(centres)[None]) ** 2).sum(-1)
    assert (d.argmin(axis=1) == pdf["cluster"].to_numpy()).mean() > 0.999


def test_pca_ratios(spark, anomaly):
    from astroframe.models.classifiers import pca_project

    df, cols = anomaly
    out, ratios = pca_project(df, 3)
    assert all(a >= b for a, b in zip(ratios, ratios[1:])) and sum(ratios) <= 1 + 1e-9
    assert {"pc1", "pc2", "pc3"} <= set(out.columns)


def test_forest_beats_majority_class(spark):
    from astroframe.models.classifiers import rf_classify
    from astroframe.models.evaluate import evaluation_dict
    from astroframe.models.frames import classification_frame
    from astroframe.plans.checks.etl import processed

    train, test, cols, classes = classification_frame(processed(spark, SF_SMALL), min_count=20)
    pred, imp = rf_classify(train, test, "spkid", trees=20, depth=8)
    ev = evaluation_dict(pred)
    majority = test.groupBy("label").count().agg(F.max("count")).first()[0] / test.count()
    assert ev["accuracy"] > majority
    assert len(imp) == len(cols) and abs(sum(imp) - 1) < 1e-6
    assert len(ev["confusion_matrix"]) == len({r["label"] for r in pred.select("label").collect()} |
                                             {r["prediction"] for r in pred.select("prediction").collect()})


def test_reconstruction_threshold(spark, anomaly):
    from astroframe.models.anomaly import reconstruction_anomaly

    df, cols = anomaly
    normal = F.col("object_type").isin("MBA", "NEO")
    out, thr, _ = reconstruction_anomaly(df, cols, normal, epochs=4)
    errs = out.where(normal).select("recon_error").toPandas()["recon_error"]
    assert thr == pytest.approx(np.quantile(errs, 0.99), rel=1e-9)
