"""Supervised and unsupervised models on Spark.

Each model takes prepared frames (``features`` vector, integer ``label``)
and returns DataFrames keyed by the row id -- predictions are never put
back by position.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from astroframe.constants import CNN_FILTERS, DNN_LAYERS, DROPOUT, ML_PARAMS, SVM_MAX_ROWS, VALIDATION_SHARE
from astroframe.models.boosting import fit_boosted_trees, predict_boosted
from astroframe.operators.comoments import comoments, principal_axes
from astroframe.functions.columns import fresh_name
from astroframe.models.forest import fit_forest, predict_forest
from astroframe.models.kernel import LANDMARKS, fit_kernel_machine, predict_kernel_machine
from astroframe.models.kmeans import fit_kmeans
from astroframe.models.network import dense_classifier, fit_network, predict_network, sequence_classifier
from astroframe.operators.sampling import cap_rows, holdout_split


def rf_classify(train: DataFrame, test: DataFrame, id_col: str, trees: int = ML_PARAMS["rf_n_estimators"],
                depth: int = ML_PARAMS["rf_max_depth"], seed: int = ML_PARAMS["random_state"]):
    """Random forest (see ``models.forest``); returns (predictions, feature importances as a list)."""
    model = fit_forest(train, trees, depth, seed)
    return predict_forest(model, test).select(id_col, "label", "prediction"), model.importances.tolist()


def importance_table(spark, names: Sequence[str], values: Sequence[float]) -> DataFrame:
    return spark.createDataFrame([(n, float(v)) for n, v in zip(names, values)], "feature string, importance double")


def svm_classify(train: DataFrame, test: DataFrame, id_col: str, c: float = ML_PARAMS["svm_C"], landmarks: int = LANDMARKS,
                 cap: int = SVM_MAX_ROWS, seed: int = 42, **options) -> DataFrame:
    """RBF kernel machine, one class against one (see ``models.kernel``).

    Training rows are capped at ``cap`` (hash order), as the reference caps its kernel solver.
    """
    model = fit_kernel_machine(cap_rows(train, id_col, cap, seed), id_col, c, landmarks, seed=seed, **options)
    return predict_kernel_machine(model, test).select(id_col, "label", "prediction")


def boosted_classify(train: DataFrame, test: DataFrame, id_col: str, rounds: int = ML_PARAMS["xgb_n_estimators"],
                     depth: int = ML_PARAMS["xgb_max_depth"], rate: float = ML_PARAMS["xgb_learning_rate"]) -> DataFrame:
    """Gradient-boosted trees over all classes at once (one softmax ensemble; see ``models.boosting``)."""
    model = fit_boosted_trees(train, rounds, depth, rate)
    return predict_boosted(model, test).select(id_col, "label", "prediction")


def _trained(net, train: DataFrame, test: DataFrame, id_col: str, features: str, validation: float, seed: int, with_history: bool, **options):
    part = fresh_name(train, "part")
    parts = holdout_split(train, id_col, validation, seed, part)
    net, record = fit_network(net, parts.where(F.col(part) == "train"), parts.where(F.col(part) == "test"), features, F.col("label"), seed=seed, **options)
    pred = predict_network(net, test, features, "prediction").select(id_col, "label", "prediction")
    return (pred, record) if with_history else pred


def mlp_classify(train: DataFrame, test: DataFrame, id_col: str, n_features: int, n_classes: int,
                 hidden: Sequence[int] = tuple(DNN_LAYERS), dropout: float = DROPOUT, seed: int = 42, with_history: bool = False,
                 features: str = "features", validation: float = VALIDATION_SHARE, **options):
    """Dense network (ReLU, batch normalisation, dropout, softmax), trained by ``models.network``.

    A ``validation`` share of the training rows (in hash order) is held out and judged after each epoch.  With
    ``with_history`` also returns the training record: loss, accuracy and their held-out values per epoch, the epochs
    trained and the number of weights.
    """
    net = dense_classifier(n_features, n_classes, hidden, dropout)
    return _trained(net, train, test, id_col, features, validation, seed, with_history, **{"plateau": True, **options})


def cnn_classify(train: DataFrame, test: DataFrame, id_col: str, length: int, n_classes: int, filters: Sequence[int] = tuple(CNN_FILTERS),
                 dense: int = 64, dropout: float = DROPOUT, seed: int = 42, with_history: bool = False, features: str = "features",
                 validation: float = VALIDATION_SHARE, **options):
    """Convolutional network over the features as a sequence (two convolutions of kernel two, mean, dense layer, softmax)."""
    net = sequence_classifier(length, n_classes, filters, dense, dropout)
    return _trained(net, train, test, id_col, features, validation, seed, with_history, **options)


def pca_project(df: DataFrame, k: int = ML_PARAMS["pca_components"], features: str = "features"):
    """PCA scores pc1..pck of the centred features (sign fixed: largest-magnitude loading positive) and explained shares.

    The axes are those of the co-moment matrix, from one pass over the rows; the scores are plain column arithmetic.
    """
    arr = vector_to_array(F.col(features))
    width = df.select(F.size(arr).alias("w")).first()
    if width is None:
        raise ValueError("no rows to project")
    x = [f"x{i}" for i in range(width["w"])]
    state = comoments(df.select(*[arr[i].alias(c) for i, c in enumerate(x)]), x)
    axes, shares = principal_axes(state)
    terms = [[(arr[i] - F.lit(float(state.mean[i]))) * F.lit(float(axes[i, j])) for i in range(len(x))] for j in range(k)]
    return df.withColumns({f"pc{j + 1}": sum(t[1:], t[0]) for j, t in enumerate(terms)}), [float(v) for v in shares[:k]]


def kmeans_cluster(df: DataFrame, k: int = ML_PARAMS["n_clusters"], starts: int = 10, seed: int = 42,
                   features: str = "features", out: str = "cluster"):
    """Rows with the nearest of the best centres, the centres and their cost; ``starts`` seeded starts in the same scans."""
    centres, cost = fit_kmeans(df, k, starts, seed, features)
    shared = df.sparkSession.sparkContext.broadcast(centres)

    @F.pandas_udf("int")
    def nearest(x: pd.Series) -> pd.Series:
        rows = np.stack(x.to_numpy())
        return pd.Series(((rows[:, None, :] - shared.value) ** 2).sum(axis=2).argmin(axis=1).astype(np.int32))

    return df.withColumn(out, nearest(vector_to_array(F.col(features)))), [list(map(float, c)) for c in centres], cost
