"""Distributed exact operators against brute force on small fixtures."""

import hashlib
import math

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from astroframe.operators.quantiles import exact_quantiles
from astroframe.operators import sampling as S


@pytest.mark.parametrize("p", [0.0, 0.01, 0.37, 0.5, 0.99, 1.0])
def test_quantiles_match_numpy_with_hot_value(spark, p):
    rng = np.random.default_rng(7)
    x = np.concatenate([rng.normal(size=3000), np.full(2500, 0.125), rng.exponential(size=500)])
    pdf = pd.DataFrame({"x": x, "y": np.where(np.arange(x.size) % 5 == 0, np.nan, x * 2)})
    got = exact_quantiles(spark.createDataFrame(pdf), ["x", "y"], p)
    assert got["x"] == pytest.approx(np.quantile(x, p), abs=1e-12)
    assert got["y"] == pytest.approx(np.nanquantile(pdf.y, p), abs=1e-12)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.integers(-50, 50), min_size=1, max_size=300), st.floats(0, 1))
def test_quantiles_property(spark, values, p):
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    assert exact_quantiles(df, ["x"], p)["x"] == pytest.approx(np.quantile(values, p), abs=1e-9)


def _md5_order(ids):
    return sorted(ids, key=lambda i: (hashlib.md5(f"{i}-42".encode()).hexdigest(), i))


def test_stratified_split_matches_window_definition(spark):
    rng = np.random.default_rng(3)
    n = 9000
    labels = np.where(rng.random(n) < 0.6, "hot", rng.choice(["a", "b", "c"], n))
    pdf = pd.DataFrame({"id": np.arange(n, dtype="int64"), "label": labels})
    out = S.stratified_split(spark.createDataFrame(pdf), "label", "id", 0.2, 42).toPandas()
    for lab, g in pdf.groupby("label"):
        k = math.ceil(len(g) * 0.2)
        expected = set(_md5_order(list(g["id"]))[:k])
        got = set(out[(out.label == lab) & (out.split == "test")]["id"])
        assert got == expected


def test_cap_and_sample_per_group(spark):
    pdf = pd.DataFrame({"id": np.arange(6000, dtype="int64"), "g": np.where(np.arange(6000) < 5000, "x", "y")})
    df = spark.createDataFrame(pdf)
    capped = set(r["id"] for r in S.cap_rows(df, "id", 4500, 42).collect())
    assert capped == set(_md5_order(list(pdf["id"]))[:4500])
    per = S.sample_per_group(df, "g", "id", 700, 42).toPandas()
    assert (per.groupby("g").size() == 700).all()


def test_silhouette_matches_brute_force(spark):
    from astroframe.models.distance import sampled_silhouette

    rng = np.random.default_rng(1)
    pts = np.vstack([rng.normal(0, 1, (40, 3)), rng.normal(4, 1, (30, 3)), rng.normal((0, 5, 0), 1, (1, 3))])
    lab = np.array([0] * 40 + [1] * 30 + [2])
    pdf = pd.DataFrame(pts, columns=["x", "y", "z"]).assign(id=np.arange(len(lab)), c=lab)
    got = sampled_silhouette(spark.createDataFrame(pdf), "id", ["x", "y", "z"], "c").first()["silhouette"]
    d = np.sqrt(((pts[:, None] - pts[None]) ** 2).sum(-1))
    s = []
    for i in range(len(lab)):
        own = lab == lab[i]
        if own.sum() == 1:
            s.append(0.0)
            continue
        a = d[i, own].sum() / (own.sum() - 1)
        b = min(d[i, lab == c].mean() for c in set(lab) if c != lab[i])
        s.append((b - a) / max(a, b))
    assert got == pytest.approx(np.mean(s), abs=1e-12)


def test_confusion_matrix_has_zero_cells(spark):
    from astroframe.operators.aggregate import confusion_matrix

    df = spark.createDataFrame([(0, 0), (0, 0), (1, 0), (2, 2)], "l int, p int")
    cells = {(r["l"], r["p"]): r["count"] for r in confusion_matrix(df, "l", "p").collect()}
    assert len(cells) == 9 and cells[(0, 0)] == 2 and cells[(1, 1)] == 0 and cells[(2, 2)] == 1


def test_histogram_density_integrates_to_one(spark):
    from astroframe.operators.aggregate import histogram

    df = spark.createDataFrame([(float(v),) for v in range(1000)], "x double")
    h = histogram(df, "x", 50).toPandas()
    assert h["count"].sum() == 1000
    assert ((h["hi"] - h["lo"]) * h["density"]).sum() == pytest.approx(1.0)


@pytest.mark.parametrize("n,parts", [(5, 13), (30, 4)])
def test_trailing_aggregates_hot_key_matches_brute_force(spark, n, parts):
    from astroframe.operators.windows import trailing_aggregates

    rng = np.random.default_rng(11)
    m = 3000
    keys = np.where(rng.random(m) < 0.8, "hot", rng.choice(["a", "b", "c", "d"], m))
    pdf = pd.DataFrame({"k": keys, "t": rng.permutation(m).astype("int64"), "v": rng.normal(size=m)})
    pdf.loc[::17, "v"] = np.nan
    df = spark.createDataFrame(pdf).withColumn("v", F.nanvl("v", F.lit(None).cast("double")))
    got = trailing_aggregates(df, "k", ["t"], "v", n, ("count", "sum", "mean", "min", "max"), parts).toPandas()
    got = got.sort_values(["k", "t"]).reset_index(drop=True)
    exp = pdf.sort_values(["k", "t"]).reset_index(drop=True)
    r = exp.groupby("k")["v"].rolling(n + 1, min_periods=1)
    for a in ("sum", "mean", "min", "max"):
        e = getattr(r, a)().reset_index(level=0, drop=True).sort_index().to_numpy()
        np.testing.assert_allclose(got[f"v_{a}"].to_numpy(dtype=float), e, rtol=1e-12, atol=1e-12)
    assert (got["v_count"].to_numpy() == np.minimum(exp.groupby("k").cumcount() + 1, n + 1)).all()


def test_first_k_hybrid_many_small_groups_and_a_hot_one(spark):
    """Hot group via thresholds, thousands of small groups via windows -- same selection."""
    import astroframe.operators.sampling as SM

    rng = np.random.default_rng(9)
    n = 40000
    g = np.where(rng.random(n) < 0.4, "hot", np.char.add("g", rng.integers(0, 3000, n).astype(str)))
    pdf = pd.DataFrame({"id": np.arange(n, dtype="int64"), "g": g})
    out = SM.stratified_split(spark.createDataFrame(pdf), "g", "id", 0.2, 42).toPandas()
    got = out.groupby("g").apply(lambda d: set(d[d.split == "test"]["id"]), include_groups=False)
    for lab, grp in pdf.groupby("g"):
        k = math.ceil(len(grp) * 0.2)
        assert got[lab] == set(_md5_order(list(grp["id"]))[:k]), lab


def test_first_k_spreads_hot_groups_over_the_slices(spark):
    """Two hot groups, a small one and NULLs: no slice of the range sort holds more than a fair share."""
    from astroframe.operators.ordering import in_order, part_starts
    from astroframe.session import stored

    n = 40000
    g = np.array(["hot1", "hot2"])[np.arange(n) % 2].astype(object)
    g[:50], g[50:90] = "small", None
    df = spark.createDataFrame(pd.DataFrame({"id": np.arange(n, dtype="int64"), "g": g})).repartition(6)
    placed = stored(in_order(df.withColumn("key", S.hash_key("id")), "g", "key", "id", parts=8), "t")
    assert max(rows for _, _, rows in part_starts(placed)) < 2 * n / 8
    got = S.sample_per_group(df, "g", "id", 300).toPandas()
    for lab in ("hot1", "hot2", "small"):
        ids = [i for i in range(n) if g[i] == lab]
        assert set(got[got.g == lab]["id"]) == set(_md5_order(ids)[:300])
    assert got["g"].notna().all()


def test_first_k_many_groups_of_every_size(spark):
    pdf = pd.DataFrame({"id": np.arange(400, dtype="int64"), "g": (np.arange(400) % 10).astype(str)})
    got = S.sample_per_group(spark.createDataFrame(pdf), "g", "id", 7, 42).toPandas()
    for lab, grp in pdf.groupby("g"):
        assert set(got[got.g == lab]["id"]) == set(_md5_order(list(grp["id"]))[:7])


def test_equal_ids_end_with_a_result_or_a_clear_error(spark):
    many = spark.createDataFrame([(7,)] * 6000 + [(i,) for i in range(100, 4100)], "id long").repartition(4)
    with pytest.raises(ValueError, match="not unique"):
        S.cap_rows(many, "id", len([i for i in _md5_order([7, *range(100, 4100)]) if i != 7][:5]) + 3000)
    assert S.cap_rows(many, "id", 10000).count() == 10000
    thrice = spark.createDataFrame([(i // 3,) for i in range(6000)], "id long")
    assert S.cap_rows(thrice, "id", 99).count() == 99
    with pytest.raises(ValueError, match="not unique"):
        S.cap_rows(thrice, "id", 100)


@pytest.mark.parametrize("values,want", [
    ([float(i) for i in range(10000)] + [math.inf], 5000.0),
    ([float(i) for i in range(10000)] + [math.inf, -math.inf], 4999.5),
    ([math.inf] * 9000 + [1.0] * 1000, math.inf),
    ([0.0] * 6000 + [1.0] * 6000, 0.5),
    ([10.0 ** (-300 + 450 * i / 20000) for i in range(20001)], 10.0 ** -75)])
def test_quantiles_with_infinities_ties_and_any_spread(spark, values, want):
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(3)
    assert exact_quantiles(df, ["x"], 0.5)["x"] == pytest.approx(want, rel=1e-12)


def test_impute_fills_a_column_with_an_infinity(spark):
    from astroframe.models.prep import impute_median

    df = spark.createDataFrame([(float(i),) for i in range(5001)] + [(math.inf,), (-math.inf,), (None,)], "x double")
    assert impute_median(df, ["x"]).where("x = 2500").count() == 2


def test_histogram_keeps_empty_bins_and_finite_edges(spark):
    from astroframe.operators.aggregate import histogram

    h = histogram(spark.createDataFrame([(0.0,), (10.0,), (math.inf,), (None,)], "x double"), "x", 50).toPandas().sort_values("bin")
    assert h["count"].tolist() == [1] + [0] * 48 + [1] and h["hi"].iloc[-1] == pytest.approx(10.0)


def test_trailing_aggregates_are_sql_frames_with_infinity_and_null(spark):
    """Truth: a plain loop over each key's rows."""
    from astroframe.operators.windows import trailing_aggregates

    rng = np.random.default_rng(4)
    special = [math.inf, -math.inf, None, 1.0, 2.5]
    data = [(("hot", None, "b")[0 if rng.random() < 0.7 else int(rng.integers(1, 3))], int(t), special[int(rng.integers(0, 5))])
            for t in rng.permutation(400)]
    df = spark.createDataFrame(data, "k string, t long, v double").repartition(5)
    got = {r["t"]: r for r in trailing_aggregates(df, "k", ["t"], "v", 3, ("count", "min", "max", "mean"), 7).collect()}
    assert len(got) == 400
    for key in ("hot", None, "b"):
        mine = sorted(r[1:] for r in data if r[0] == key)
        for i, (t, _) in enumerate(mine):
            frame = mine[max(0, i - 3):i + 1]
            vals = [v for _, v in frame if v is not None]
            r = got[t]
            assert r["v_count"] == len(frame)
            assert r["v_min"] == (min(vals) if vals else None) and r["v_max"] == (max(vals) if vals else None)
            want = sum(vals) / len(vals) if vals else None
            assert r["v_mean"] == want or math.isnan(r["v_mean"]) and math.isnan(want)


def test_full_silhouette_matches_all_pairs(spark):
    from astroframe.models.distance import silhouette

    rng = np.random.default_rng(1)
    pts = np.vstack([rng.normal(0, 1, (40, 3)), rng.normal(4, 1, (30, 3)), rng.normal((0, 5, 0), 1, (1, 3))])
    lab = np.array([0] * 40 + [1] * 30 + [2])
    pdf = pd.DataFrame(pts, columns=["x", "y", "z"]).assign(id=np.arange(len(lab)), c=lab)
    got = silhouette(spark.createDataFrame(pdf), "id", ["x", "y", "z"], "c").first()["silhouette"]
    d = ((pts[:, None] - pts[None]) ** 2).sum(-1)
    s = []
    for i in range(len(lab)):
        own = lab == lab[i]
        a = d[i, own].sum() / (own.sum() - 1) if own.sum() > 1 else None
        b = min(d[i, lab == c].mean() for c in set(lab) if c != lab[i])
        s.append(0.0 if a is None else (b - a) / max(a, b))
    assert got == pytest.approx(np.mean(s), abs=1e-10)


def test_label_codes_without_a_bound(spark):
    from astroframe.operators.classify import label_encode

    df = spark.createDataFrame([(f"c{i % 300:03d}" if i % 7 else None, i) for i in range(3000)], "lab string, id long")
    got = label_encode(df, "lab").collect()
    assert len(got) == 3000 and all(r["label"] == (None if r["lab"] is None else int(r["lab"][1:])) for r in got)


def test_frame_sample_reads_the_path_once_without_join_or_shuffle(spark):
    from astroframe.operators.joins import frame_sample

    path = spark.range(3).selectExpr("id AS k", "explode(sequence(0, 99)) AS j").withColumn("r", F.col("j") * 1.0)
    out = frame_sample(path, "k", "j", 100, 60)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan
    assert sorted((r["k"], r["frame"], r["j"]) for r in out.collect()) == [
        (k, f, int(f / 60 * 99)) for k in range(3) for f in range(60)]


def test_scratch_needs_a_shared_folder_off_local(spark, monkeypatch):
    from astroframe import session

    class Context:
        master = "spark://somewhere:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda *a: None)

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_dir(Session())


def test_evaluation_dict_matches_spark_aggregate(spark):
    from astroframe.models.evaluate import evaluate, evaluation_dict

    rng = np.random.default_rng(2)
    lab = rng.integers(0, 4, 500)
    pred = np.where(rng.random(500) < 0.7, lab, rng.integers(0, 5, 500))
    df = spark.createDataFrame(pd.DataFrame({"label": lab, "prediction": pred}))
    a = evaluate(df).first().asDict()
    b = evaluation_dict(df)
    for k in ("accuracy", "precision", "recall", "f1"):
        assert a[k] == pytest.approx(b[k], abs=1e-12)
    assert sum(map(sum, b["confusion_matrix"])) == 500 and len(b["confusion_matrix"]) == 5


def test_fixed_cuts_with_hot_and_small_groups(spark, monkeypatch):
    """A hot group, groups at and under k, repeated ids within the cut, and a margin that leaves groups short."""
    rows = [("hot", i) for i in range(8000)] + [("edge", 10_000 + i) for i in range(50)] + [("small", 20_000 + i) for i in range(7)]
    rows += [(f"g{i % 40}", 30_000 + i) for i in range(4000)] + [(None, 90_000 + i) for i in range(30)]
    df = spark.createDataFrame(rows, "g string, id long").repartition(5)

    def first(k):
        got = S.sample_per_group(df, "g", "id", k).collect()
        by = {}
        for r in got:
            by.setdefault(r["g"], set()).add(r["id"])
        return by

    groups = {g: [i for h, i in rows if h == g] for g in {g for g, _ in rows if g}}
    want = {g: set(_md5_order(ids)[:50]) for g, ids in groups.items()}
    assert first(50) == want
    monkeypatch.setattr(S.math, "sqrt", lambda v: -v / 6 - 15)  # bounds far too low: every group is widened
    assert first(50) == want


def test_fixed_cuts_do_not_sort_the_table(spark, monkeypatch):
    monkeypatch.setattr(S, "in_order", None)  # the range sort that shares need
    df = spark.range(5000).withColumn("g", F.lit("a"))
    assert S.sample_per_group(df, "g", "id", 10).count() == S.cap_rows(df, "id", 10).count() == 10


def test_repeated_ids_on_a_cut_raise(spark):
    df = spark.createDataFrame([(1, "a")] * 500 + [(2, "a")], "id long, g string")
    with pytest.raises(ValueError, match="not unique"):
        S.sample_per_group(df, "g", "id", 100).collect()


def test_selection_and_windows_keep_columns_of_any_name(spark):
    from astroframe.operators.windows import trailing_aggregates

    names = ["base", "part", "idx", "slice", "rank", "own", "row", "v", "s0", "tg", "cut", "first", "_first", "_tg", "_cut", "target", "low"]
    df = spark.range(200).select("id", F.lit("k").alias("g"), F.col("id").cast("double").alias("x"), *[F.lit(n).alias(n) for n in names])
    for out in (S.stratified_split(df, "g", "id"), S.holdout_split(df, "id"), S.sample_per_group(df, "g", "id", 20), S.cap_rows(df, "id", 20),
                trailing_aggregates(df, "g", ["id"], "x", 3)):
        assert set(df.columns) <= set(out.columns)
        row = out.first()
        assert all(row[n] == n for n in names)


@pytest.mark.parametrize("margin", [2.0, -1.0])
def test_quantiles_of_large_brackets(spark, monkeypatch, margin):
    """A coarse sketch: brackets too large to gather are looked up by rank; brackets that miss are widened."""
    from astroframe.operators import quantiles as Q

    monkeypatch.setattr(Q, "SKETCH", 20)
    monkeypatch.setattr(Q, "GATHER", 30)
    monkeypatch.setattr(Q, "MARGIN", margin if margin > 0 else 1e-9)
    rng = np.random.default_rng(5)
    x = np.concatenate([rng.normal(size=2000), np.full(700, 0.25), [1e308, -1e300] * 20])
    df = spark.createDataFrame(pd.DataFrame({"x": rng.permutation(x), "y": np.arange(len(x), dtype=float)})).repartition(4)
    for p in (0.0, 0.3, 0.5, 0.61, 0.97, 1.0):
        got = exact_quantiles(df, ["x", "y", "x"], p)
        assert got["x"] == pytest.approx(np.quantile(x, p), nan_ok=True) and got["y"] == pytest.approx(np.quantile(np.arange(len(x)), p))


def test_quantiles_scan_three_times_and_persist_nothing(spark):
    from astroframe.operators import quantiles as Q

    reads = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def seen(v):
        reads.add(1)
        return v

    n = 20_000
    df = spark.range(n).select(seen(F.rand(3)).alias("x"))
    exact_quantiles(df, ["x"], 0.5)
    assert reads.value == 3 * n and n > Q.GATHER
    assert spark.sparkContext._jsc.getPersistentRDDs().isEmpty()
