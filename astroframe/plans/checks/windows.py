"""2.7 windows / splits and 2.8 sorts, limits, top-k, sampling."""

from __future__ import annotations

from pyspark.sql import functions as F

from astroframe.constants import SVM_MAX_ROWS
from astroframe.operators import sampling as S
from astroframe.plans.checks.etl import processed
from astroframe.plans.registry import query
from astroframe.sources.fixtures import bodies, ephemeris, model_runs
from astroframe.sources.tables import table

_MD5 = "md5(CAST(spkid AS VARCHAR) || '-42')"


@query("trailing_window",
       "SELECT object, datetime, count(*) OVER w AS n_trail, avg(r) OVER w AS r_trail, "
       "min(r) OVER w AS r_min FROM ephemeris "
       "WINDOW w AS (PARTITION BY object ORDER BY datetime, r ROWS BETWEEN 30 PRECEDING AND CURRENT ROW)",
       views=["ephemeris"], round_cols=["r_trail"])
def q_trailing_window(spark, sf):
    from astroframe.operators.windows import trailing_aggregates

    e = ephemeris(spark, sf).select("object", "datetime", "r")
    out = trailing_aggregates(e, "object", ["datetime", "r"], "r", 30, ("count", "mean", "min"))
    return out.select("object", "datetime", F.col("r_count").alias("n_trail"),
                      F.col("r_mean").alias("r_trail"), F.col("r_min"))


@query("stratified_split",
       f"SELECT spkid, object_type, CASE WHEN rn <= ceil(n * 0.2) THEN 'test' ELSE 'train' END AS split "
       f"FROM (SELECT spkid, object_type, row_number() OVER (PARTITION BY object_type ORDER BY {_MD5}, spkid) AS rn, "
       f"count(*) OVER (PARTITION BY object_type) AS n FROM processed WHERE object_type IS NOT NULL) t",
       views=["processed"])
def q_stratified_split(spark, sf):
    p = processed(spark, sf).where(F.col("object_type").isNotNull()).select("spkid", "object_type")
    return S.stratified_split(p, "object_type", "spkid", 0.2, 42)


@query("holdout_split",
       f"SELECT spkid, CASE WHEN rn <= ceil(n * 0.15) THEN 'test' ELSE 'train' END AS split "
       f"FROM (SELECT spkid, row_number() OVER (ORDER BY {_MD5}, spkid) AS rn, count(*) OVER () AS n "
       f"FROM processed WHERE object_type IN ('MBA', 'NEO')) t", views=["processed"])
def q_holdout_split(spark, sf):
    p = processed(spark, sf).where(F.col("object_type").isin("MBA", "NEO")).select("spkid")
    return S.holdout_split(p, "spkid", 0.15, 42)


@query("sample_per_group",
       f"SELECT spkid, object_type FROM (SELECT spkid, object_type, row_number() OVER "
       f"(PARTITION BY object_type ORDER BY {_MD5}, spkid) AS rn FROM processed WHERE object_type IS NOT NULL) t "
       f"WHERE rn <= 3000", views=["processed"])
def q_sample_per_group(spark, sf):
    p = processed(spark, sf).where(F.col("object_type").isNotNull()).select("spkid", "object_type")
    return S.sample_per_group(p, "object_type", "spkid", 3000, 42)


@query("order_desc",
       "SELECT object_type, count(*) AS count FROM processed GROUP BY object_type", views=["processed"])
def q_order_desc(spark, sf):
    from astroframe.operators.aggregate import count_by
    return count_by(processed(spark, sf), "object_type", desc=True)


@query("topk_features",
       "SELECT model, accuracy FROM model_runs WHERE accuracy IS NOT NULL ORDER BY accuracy DESC, model LIMIT 5",
       views=["model_runs"])
def q_topk(spark, sf):
    m = model_runs(spark, sf).where(F.col("accuracy").isNotNull()).select("model", "accuracy")
    return S.topk(m, "accuracy", 5, "model")


@query("head_n", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 100")
def q_head_n(spark, sf):
    return S.head_n(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), ["o_orderkey"], 100)


@query("cap_training_rows",
       f"SELECT spkid FROM (SELECT spkid, row_number() OVER (ORDER BY {_MD5}, spkid) AS rn FROM processed) t "
       f"WHERE rn <= {SVM_MAX_ROWS}", views=["processed"])
def q_cap_training_rows(spark, sf):
    return S.cap_rows(processed(spark, sf).select("spkid"), "spkid", SVM_MAX_ROWS, 42)


@query("capped_sample",
       f"SELECT spkid, e FROM (SELECT spkid, e, row_number() OVER (ORDER BY {_MD5}, spkid) AS rn FROM bodies) t "
       f"WHERE rn <= 10000", views=["bodies"])
def q_capped_sample(spark, sf):
    return S.cap_rows(bodies(spark, sf).select("spkid", "e"), "spkid", 10000, 42)


@query("sample_keep_rare",
       f"SELECT spkid, object_type FROM (SELECT spkid, object_type, row_number() OVER (ORDER BY {_MD5}, spkid) AS rn "
       f"FROM processed WHERE object_type IS DISTINCT FROM 'ISO') t WHERE rn <= 7000 "
       f"UNION ALL SELECT spkid, object_type FROM processed WHERE object_type = 'ISO'", views=["processed"])
def q_sample_keep_rare(spark, sf):
    p = processed(spark, sf).select("spkid", "object_type")
    return S.sample_keep_rare(p, F.col("object_type") == "ISO", "spkid", 8000, 7000, 42)
