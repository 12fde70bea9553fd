"""2.11 scalar functions and the date spine."""

from __future__ import annotations

from pyspark.sql import functions as F

from astroframe.functions import arrays as AR
from astroframe.functions import text as TX
from astroframe.functions.columns import clamp, rounded
from astroframe.operators.trajectory import date_spine
from astroframe.plans.registry import query
from astroframe.sources.fixtures import bodies, ephemeris
from astroframe.sources.tables import table

_MATH_COLS = ["abs_a", "sqrt_e", "cos_i", "sin_i", "acos_e", "log10_a", "pow_a", "pmod_om", "round_e", "floor_w"]


@query("fn_math",
       "SELECT spkid, abs(a) AS abs_a, sqrt(e) AS sqrt_e, cos(radians(i)) AS cos_i, sin(radians(i)) AS sin_i, "
       "acos(CASE WHEN e > 1 THEN 1.0e0 WHEN e < -1 THEN -1.0e0 ELSE e END) AS acos_e, "
       "log10(greatest(0.01e0, abs(a))) AS log10_a, pow(abs(a), 1.5e0) AS pow_a, "
       "(((om + 100.0e0) % 360.0e0) + 360.0e0) % 360.0e0 AS pmod_om, "
       "CAST(floor(e * 1000.0 + 0.5) AS DOUBLE) / 1000.0 AS round_e, CAST(floor(w / 7.0e0) AS BIGINT) AS floor_w "
       "FROM bodies WHERE e >= 0", views=["bodies"], round_cols=_MATH_COLS[:-1])
def q_fn_math(spark, sf):
    b = bodies(spark, sf).where(F.col("e") >= 0)
    return b.select(
        "spkid", F.abs("a").alias("abs_a"), F.sqrt("e").alias("sqrt_e"),
        F.cos(F.radians("i")).alias("cos_i"), F.sin(F.radians("i")).alias("sin_i"),
        F.acos(clamp("e", -1.0, 1.0)).alias("acos_e"),
        F.log10(F.greatest(F.lit(0.01), F.abs("a"))).alias("log10_a"),
        F.pow(F.abs("a"), F.lit(1.5)).alias("pow_a"),
        F.pmod(F.col("om") + F.lit(100.0), F.lit(360.0)).alias("pmod_om"),
        rounded("e", 3).alias("round_e"), F.floor(F.col("w") / F.lit(7.0)).alias("floor_w"))


@query("fn_string",
       "SELECT o_orderkey, split_part(o_orderpriority, '-', 2) AS level, "
       "upper(substr(split_part(o_orderpriority, '-', 2), 1, 1)) || lower(substr(split_part(o_orderpriority, '-', 2), 2)) "
       "AS level_cap, substr(o_orderpriority, 1, 3) AS prefix3, lpad(CAST(o_orderkey AS VARCHAR), 8, '0') AS padded, "
       "concat_ws('/', o_orderstatus, o_orderpriority) AS joined, printf('%.2f', o_totalprice) AS price_txt FROM orders")
def q_fn_string(spark, sf):
    o = table(spark, sf, "orders")
    lvl = TX.part("o_orderpriority", "-", 2)
    return o.select("o_orderkey", lvl.alias("level"), TX.capitalize(lvl).alias("level_cap"),
                    TX.prefix("o_orderpriority", 3).alias("prefix3"),
                    F.lpad(F.col("o_orderkey").cast("string"), 8, "0").alias("padded"),
                    F.concat_ws("/", "o_orderstatus", "o_orderpriority").alias("joined"),
                    F.format_string("%.2f", "o_totalprice").alias("price_txt"))


@query("fn_datetime",
       "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d, strftime(o_orderdate, '%Y-%m-%d') AS d_txt, "
       "CAST(strptime(strftime(o_orderdate, '%Y-%m-%d'), '%Y-%m-%d') AS TIMESTAMP) AS parsed, "
       "CAST(datediff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) AS INTEGER) AS days, "
       "CAST(year(o_orderdate) AS INTEGER) AS yr, CAST(month(o_orderdate) AS INTEGER) AS mon, "
       "CAST(CAST(o_orderdate AS DATE) + INTERVAL 30 DAY AS DATE) AS plus30 FROM orders")
def q_fn_datetime(spark, sf):
    o = table(spark, sf, "orders")
    txt = F.date_format("o_orderdate", "yyyy-MM-dd")
    return o.select("o_orderkey", F.to_date("o_orderdate").alias("d"), txt.alias("d_txt"),
                    F.to_timestamp_ntz(txt, F.lit("yyyy-MM-dd")).alias("parsed"),
                    F.datediff(F.to_date("o_orderdate"), F.lit("1995-01-01").cast("date")).alias("days"),
                    F.year("o_orderdate").alias("yr"), F.month("o_orderdate").alias("mon"),
                    F.date_add(F.to_date("o_orderdate"), 30).alias("plus30"))


@query("fn_array",
       "SELECT vec_id, list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE))) / len(embedding) "
       "AS mean_sq, CAST(embedding[3] AS DOUBLE) AS third, len(embedding) AS n, "
       "list_sum(list_transform(list_zip(embedding, list_reverse(embedding)), "
       "lambda p: (CAST(p[1] AS DOUBLE) - CAST(p[2] AS DOUBLE)) * (CAST(p[1] AS DOUBLE) - CAST(p[2] AS DOUBLE)))) "
       "/ len(embedding) AS msd FROM embeddings",
       round_cols=["mean_sq", "msd", "third"])
def q_fn_array(spark, sf):
    e = table(spark, sf, "embeddings")
    return e.select("vec_id", AR.mean_square("embedding").alias("mean_sq"),
                    F.element_at("embedding", 3).cast("double").alias("third"),
                    F.size("embedding").cast("long").alias("n"),
                    AR.mean_square_diff("embedding", F.reverse("embedding")).alias("msd"))


@query("fn_json",
       "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, "
       "coalesce(CAST(json_extract_string(props, '$.missing') AS BIGINT), 0) AS missing_or_default FROM events")
def q_fn_json(spark, sf):
    ev = table(spark, sf, "events")
    parsed = F.from_json("props", "k long, missing long")
    return ev.select("event_id", parsed["k"].alias("k"),
                     F.coalesce(parsed["missing"], F.lit(0).cast("long")).alias("missing_or_default"))


@query("date_spine",
       "WITH b AS (SELECT object, min(CAST(datetime AS DATE)) AS d0, max(CAST(datetime AS DATE)) AS d1 "
       "FROM ephemeris GROUP BY object) SELECT object, CAST(d AS DATE) AS date, "
       "CAST(datediff('day', d0, CAST(d AS DATE)) AS INTEGER) AS days "
       "FROM b, unnest(generate_series(d0, d1, INTERVAL 1 DAY)) AS t(d)", views=["ephemeris"])
def q_date_spine(spark, sf):
    return date_spine(ephemeris(spark, sf), "object", "datetime").select("object", "date", "days")
