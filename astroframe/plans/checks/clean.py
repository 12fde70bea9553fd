"""2.2 projections / filters / predicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from astroframe.constants import FEATURES_ALL, FEATURES_ENGINEERED
from astroframe.functions import columns as C
from astroframe.operators import clean as CL
from astroframe.plans.checks.etl import processed
from astroframe.plans.registry import query
from astroframe.sources.fixtures import bodies, ephemeris
from astroframe.sources.tables import table

FEATS = FEATURES_ALL + FEATURES_ENGINEERED


@query("project_fields", "SELECT spkid, full_name, e, a FROM bodies", views=["bodies"])
def q_project_fields(spark, sf):
    return CL.project_fields(bodies(spark, sf), ["spkid", "full_name", "e", "a"])


@query("project_available", "SELECT spkid, " + ", ".join(f'"{c}"' for c in FEATS) + " FROM processed",
       views=["processed"], round_cols=FEATS)
def q_project_available(spark, sf):
    return CL.project_available(processed(spark, sf), ["spkid"] + FEATS + ["not_a_column"])


@query("rename_column", "SELECT event_id, ts AS datetime, value FROM events")
def q_rename_column(spark, sf):
    ev = table(spark, sf, "events").select("event_id", "ts", "value")
    return CL.rename_columns(ev, {"ts": "datetime", "absent": "x"})


@query("tag_literal", "SELECT object, datetime, r, 'horizons' AS source FROM ephemeris", views=["ephemeris"])
def q_tag_literal(spark, sf):
    return CL.tag_literal(ephemeris(spark, sf).drop("event_type"), "source", "horizons")


@query("cast_numeric",
       "SELECT o_orderkey, TRY_CAST(o_orderpriority AS DOUBLE) AS o_orderpriority, "
       "TRY_CAST(substr(o_orderpriority, 1, 1) AS DOUBLE) AS prio_digit FROM orders")
def q_cast_numeric(spark, sf):
    o = table(spark, sf, "orders").select(
        "o_orderkey", "o_orderpriority", F.substring("o_orderpriority", 1, 1).alias("prio_digit"))
    return CL.cast_numeric(o, ["o_orderpriority", "prio_digit", "absent"])


@query("drop_incomplete", "SELECT spkid, e, a FROM bodies WHERE e IS NOT NULL AND a IS NOT NULL",
       views=["bodies"])
def q_drop_incomplete(spark, sf):
    return CL.drop_incomplete(bodies(spark, sf), ["e", "a"]).select("spkid", "e", "a")


@query("filter_range", "SELECT spkid, e FROM bodies WHERE e >= 0", views=["bodies"])
def q_filter_range(spark, sf):
    return CL.filter_range(bodies(spark, sf), "e", lo=0).select("spkid", "e")


@query("filter_kind", "SELECT spkid, kind, class FROM bodies WHERE kind = 'c'", views=["bodies"])
def q_filter_kind(spark, sf):
    return CL.filter_equals(bodies(spark, sf), "kind", "c").select("spkid", "kind", "class")


@query("clamp",
       "SELECT spkid, CASE WHEN i > 180 THEN 180.0e0 WHEN i < 0 THEN 0.0e0 ELSE i END AS i, "
       "CASE WHEN a > 100 THEN 100.0e0 WHEN a < -10 THEN -10.0e0 ELSE a END AS a_plot, "
       "CASE WHEN a > 10 THEN 10.0e0 WHEN a < -10 THEN -10.0e0 ELSE a END AS a_iso, "
       "CASE WHEN q > 50 THEN 50.0e0 WHEN q < 0 THEN 0.0e0 ELSE q END AS q_clip FROM bodies",
       views=["bodies"])
def q_clamp(spark, sf):
    b = CL.clamp(bodies(spark, sf), "i", 0, 180)
    return b.select("spkid", "i", C.clamp("a", -10, 100).alias("a_plot"),
                    C.clamp("a", -10, 10).alias("a_iso"), C.clamp("q", 0, 50).alias("q_clip"))


@query("null_outside",
       'SELECT spkid, CASE WHEN "H" < -5 OR "H" > 35 THEN NULL ELSE "H" END AS "H" FROM bodies',
       views=["bodies"])
def q_null_outside(spark, sf):
    return CL.null_outside(bodies(spark, sf), "H", -5, 35).select("spkid", "H")


@query("null_nonpositive",
       "SELECT spkid, CASE WHEN diameter <= 0 THEN NULL ELSE diameter END AS diameter FROM bodies",
       views=["bodies"])
def q_null_nonpositive(spark, sf):
    return CL.null_nonpositive(bodies(spark, sf), "diameter").select("spkid", "diameter")


@query("filter_in", "SELECT spkid, object_type FROM processed WHERE object_type IN ('MBA', 'NEO')",
       views=["processed"])
def q_filter_in(spark, sf):
    return CL.filter_in(processed(spark, sf), "object_type", ["MBA", "NEO"]).select("spkid", "object_type")


@query("filter_equals", "SELECT spkid, full_name, e FROM processed WHERE object_type = 'ISO'",
       views=["processed"])
def q_filter_equals(spark, sf):
    return CL.filter_equals(processed(spark, sf), "object_type", "ISO").select("spkid", "full_name", "e")


@query("filter_not_equals", "SELECT spkid, object_type FROM processed WHERE object_type <> 'ISO'",
       views=["processed"])
def q_filter_not_equals(spark, sf):
    return CL.filter_equals(processed(spark, sf), "object_type", "ISO", negate=True).select(
        "spkid", "object_type")


@query("rows_removed",
       "SELECT count(*) AS total, count(*) FILTER (WHERE e IS NOT NULL AND a IS NOT NULL AND e >= 0) AS kept, "
       "count(*) - count(*) FILTER (WHERE e IS NOT NULL AND a IS NOT NULL AND e >= 0) AS dropped FROM bodies",
       views=["bodies"])
def q_rows_removed(spark, sf):
    keep = F.col("e").isNotNull() & F.col("a").isNotNull() & (F.col("e") >= 0)
    return CL.rows_removed(bodies(spark, sf), keep)
