"""2.3 domain projections (feature engineering)."""

from __future__ import annotations

from pyspark.sql import functions as F

from astroframe.operators import features as FE
from astroframe.operators.features import clean_catalogue
from astroframe.plans.registry import query, sql_rounded
from astroframe.sources.fixtures import bodies
from astroframe.sources.tables import table


def cleaned(spark, sf):
    return clean_catalogue(bodies(spark, sf))


@query("feat_tisserand",
       "SELECT spkid, CASE WHEN e <= 1 THEN (CASE WHEN a <> 0 THEN 5.2044e0 / a END) + 2.0e0 * cos(radians(i)) "
       "* sqrt(abs(a / 5.2044e0) * (1.0e0 - e * e)) END AS tisserand_j FROM cleaned",
       views=["cleaned"], round_cols=["tisserand_j"])
def q_tisserand(spark, sf):
    return FE.add_tisserand(cleaned(spark, sf)).select("spkid", "tisserand_j")


@query("feat_v_inf",
       "SELECT spkid, CASE WHEN e > 1.0 THEN (CASE WHEN a <> 0 THEN sqrt(abs(1.0e0 / a)) * 29.78e0 END) "
       "ELSE 0.0e0 END AS v_inf FROM cleaned", views=["cleaned"], round_cols=["v_inf"])
def q_v_inf(spark, sf):
    return FE.add_v_inf(cleaned(spark, sf)).select("spkid", "v_inf")


@query("feat_energy", "SELECT spkid, CASE WHEN a <> 0 THEN -1.0e0 / (2.0e0 * a) END AS energy_param FROM cleaned",
       views=["cleaned"], round_cols=["energy_param"])
def q_energy(spark, sf):
    return FE.add_energy(cleaned(spark, sf)).select("spkid", "energy_param")


@query("feat_q_over_a", "SELECT spkid, CASE WHEN a <> 0 THEN abs(q / a) END AS q_over_a FROM cleaned",
       views=["cleaned"], round_cols=["q_over_a"])
def q_q_over_a(spark, sf):
    return FE.add_q_over_a(cleaned(spark, sf)).select("spkid", "q_over_a")


@query("derive_orbital",
       "SELECT spkid, " + sql_rounded("a * (1 - e)", 6) + " AS q, " + sql_rounded("a * (1 + e)", 6) + " AS ad, "
       + sql_rounded("pow(a, 1.5)", 4) + " AS per_y, "
       "CASE WHEN neo = 'Y' AND moid < 0.05 THEN 'Y' ELSE 'N' END AS pha "
       "FROM bodies WHERE a > 0 AND e IS NOT NULL", views=["bodies"])
def q_derive_orbital(spark, sf):
    b = bodies(spark, sf).filter((F.col("a") > 0) & F.col("e").isNotNull())
    return FE.derive_orbital(b).select("spkid", "q", "ad", "per_y", "pha")


# fixed values: the first object's visibility curve parameters
VIS = dict(r0=0.255, k1=0.015, k2=0.0001, mag0=26.0, ra0=45.0, ra_rate=0.3, alpha0=90.0, alpha_rate=0.5)
_days = "CAST(datediff('day', DATE '2024-01-15', CAST(ts AS DATE)) AS DOUBLE)"
_r = f"(0.255e0 + 0.015e0 * abs({_days}) + 0.0001e0 * {_days} * {_days})"


@query("derive_visibility",
       f"SELECT event_id, {_days} AS days, {sql_rounded(_r, 4)} AS r, "
       f"{sql_rounded(f'26.0e0 - 2.5e0 * log10(greatest(0.01e0, 1.0e0 / ({_r} * {_r})))', 2)} AS \"V\", "
       f"{sql_rounded(f'(((45.0e0 + {_days} * 0.3e0) % 360.0e0) + 360.0e0) % 360.0e0', 4)} AS \"RA\", "
       f"{sql_rounded(f'greatest(0.0e0, 90.0e0 - abs({_days}) * 0.5e0)', 2)} AS alpha FROM events")
def q_derive_visibility(spark, sf):
    ev = table(spark, sf, "events").select(
        "event_id", F.to_date("ts").alias("date"), F.lit("2024-01-15").cast("date").alias("event"))
    return FE.derive_visibility(ev, "date", "event", **VIS).select("event_id", "days", "r", "V", "RA", "alpha")


@query("color_index",
       "SELECT vec_id, CAST(embedding[1] AS DOUBLE) - CAST(embedding[2] AS DOUBLE) AS u_g, "
       "CAST(embedding[2] AS DOUBLE) - CAST(embedding[3] AS DOUBLE) AS g_r, "
       "CAST(embedding[3] AS DOUBLE) - CAST(embedding[4] AS DOUBLE) AS r_i, "
       "CAST(embedding[4] AS DOUBLE) - CAST(embedding[5] AS DOUBLE) AS i_z FROM embeddings",
       round_cols=["u_g", "g_r", "r_i", "i_z"])
def q_color_index(spark, sf):
    mags = ["u", "g", "r", "i", "z"]
    e = table(spark, sf, "embeddings").select(
        "vec_id", *[F.element_at("embedding", n + 1).cast("double").alias(m) for n, m in enumerate(mags)])
    return FE.color_index(e, mags).select("vec_id", "u_g", "g_r", "r_i", "i_z")
