"""One-pass co-moments, principal axes and many-start k-means against numpy."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from astroframe.models.classifiers import kmeans_cluster, pca_project
from astroframe.models.kmeans import fit_kmeans, seeds
from astroframe.operators.aggregate import covariance_matrix
from astroframe.operators.comoments import CoMoments, comoments


def frame(spark, x, parts=4):
    names = [f"c{i}" for i in range(x.shape[1])]
    rows = [(i, *[None if np.isnan(v) else float(v) for v in r]) for i, r in enumerate(x)]
    df = spark.createDataFrame(rows, "id long, " + ", ".join(f"{n} double" for n in names)).repartition(parts)
    return df.withColumn("features", array_to_vector(F.array(*names))), names


def test_covariance_far_from_zero(spark):
    x = np.random.default_rng(0).normal(size=(700, 3)) @ np.array([[2, 1, 0], [0, 1, 0.5], [0, 0, 1e-3]]) + 1e7
    df, names = frame(spark, x)
    want = np.cov(x.T, bias=True)
    got = {(r["col_i"], r["col_j"]): r["cov"] for r in covariance_matrix(df, names).collect()}
    assert len(got) == 6
    for (a, b), v in got.items():
        assert v == pytest.approx(want[int(a[1]), int(b[1])], rel=1e-6, abs=1e-9)


def test_states_merge_and_rows_with_gaps_are_left_out(spark):
    x = np.random.default_rng(1).normal(size=(50, 2))
    whole, parts = CoMoments.of(x), CoMoments.of(x[:0]) + CoMoments.of(x[:13]) + CoMoments.of(x[13:])
    np.testing.assert_allclose(whole.product, parts.product)
    np.testing.assert_allclose(whole.mean, parts.mean)
    gaps = x.copy()
    gaps[::5, 1] = np.nan
    state = comoments(*frame(spark, gaps))
    assert state.n == 40
    np.testing.assert_allclose(state.covariance(), np.cov(gaps[~np.isnan(gaps[:, 1])].T, bias=True))
    df, names = frame(spark, gaps)
    assert covariance_matrix(df.where("id < 0"), names).where("cov IS NOT NULL").count() == 0


def test_pca_scores_and_shares(spark):
    x = np.random.default_rng(2).normal(size=(300, 4)) * [5, 2, 1, 0.1] + 3
    df, names = frame(spark, x)
    out, shares = pca_project(df, 2)
    values, axes = np.linalg.eigh(np.cov(x.T, bias=True))
    np.testing.assert_allclose(shares, (values[::-1] / values.sum())[:2])
    got = np.array([[r["pc1"], r["pc2"]] for r in out.orderBy("id").collect()])
    np.testing.assert_allclose(np.abs(got), np.abs((x - x.mean(axis=0)) @ axes[:, ::-1][:, :2]), atol=1e-9)


def lloyd(x, c, iterations=50):
    for _ in range(iterations):
        own = ((x[:, None] - c) ** 2).sum(axis=2).argmin(axis=1)
        fresh = np.array([x[own == j].mean(axis=0) if (own == j).any() else c[j] for j in range(len(c))])
        if ((fresh - c) ** 2).sum(axis=1).max() <= 1e-8:
            break
        c = fresh
    return ((x[:, None] - c) ** 2).sum(axis=2).min(axis=1).sum()


def test_starts_advance_as_single_fits_would(spark):
    rng = np.random.default_rng(3)
    x = np.vstack([rng.normal(m, 0.4, size=(80, 2)) for m in ((0, 0), (3, 0), (0, 3), (4, 4), (8, 1))])
    df, _ = frame(spark, x)
    centres, cost = fit_kmeans(df, 5, 6, 42, tolerance=1e-12)
    sample = np.array(sorted(map(tuple, x)))
    alone = [lloyd(x, seeds(sample, 5, np.random.default_rng([42, s]))) for s in range(6)]
    assert cost == pytest.approx(min(alone), rel=1e-6)
    out, centres, cost = kmeans_cluster(df, 5, 6, 42)
    rows = out.select("id", "cluster").collect()
    near = ((x[:, None] - np.array(centres)) ** 2).sum(axis=2).argmin(axis=1)
    assert all(r["cluster"] == near[r["id"]] for r in rows)


def test_kmeans_with_fewer_distinct_rows_than_centres(spark):
    df, _ = frame(spark, np.array([[1.0, 1.0]] * 30 + [[2.0, 2.0]] * 3))
    assert fit_kmeans(df, 4, 3, 1)[1] == pytest.approx(0.0, abs=1e-9)
    with pytest.raises(ValueError, match="no rows"):
        fit_kmeans(df.where("id < 0"), 2, 1, 1)
