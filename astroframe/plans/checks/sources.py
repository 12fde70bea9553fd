"""2.1 scans, sources and sinks (round trips through the shared scratch folder)."""

from __future__ import annotations

from pyspark.sql import functions as F

from astroframe import schema as SC
from astroframe.constants import CATALOGUE_FIELDS, INTERSTELLAR_ROWS, KNOWN_INTERSTELLAR_ROWS
from astroframe.operators import reshape as R
from astroframe.operators.clean import cast_numeric
from astroframe.operators.features import etl_full
from astroframe.operators.joins import dim_join, interstellar_dimension
from astroframe.plans.checks.etl import PROCESSED_DOUBLES, processed
from astroframe.plans.checks.reshape import COMPARISON_SQL, run_documents
from astroframe.plans.oracle_views import CLEANED, PROCESSED, add_view
from astroframe.plans.registry import query
from astroframe.plans.runs import run_comparison
from astroframe.session import scratch_path
from astroframe.sources import catalog_io as IO
from astroframe.sources.payload import read_positional_payload, write_positional_payload
from astroframe.sources.fixtures import bodies, ephemeris, galaxies, model_runs


def _sql_value(v):
    if v is None:
        return "NULL"
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    return f"{float(v)!r}e0" if "e" not in repr(float(v)) else repr(float(v))


_KNOWN_VALUES = ", ".join("(" + ", ".join(_sql_value(r[c]) for c in CATALOGUE_FIELDS) + ")"
                          for r in KNOWN_INTERSTELLAR_ROWS)
_COLS = ", ".join(f'"{c}"' for c in CATALOGUE_FIELDS)
add_view("bodies_known", f"SELECT {_COLS} FROM bodies UNION ALL SELECT * FROM (VALUES {_KNOWN_VALUES}) AS k({_COLS})",
         ("bodies",))
add_view("cleaned_known", CLEANED.replace("FROM bodies", "FROM bodies_known"), ("bodies_known",))
add_view("processed_known", PROCESSED.replace("FROM cleaned", "FROM cleaned_known"), ("cleaned_known",))

_RAW_DOUBLES = [c for c in CATALOGUE_FIELDS if c in PROCESSED_DOUBLES]


@query("scan_csv", "SELECT * FROM bodies", views=["bodies"])
def q_scan_csv(spark, sf):
    path = scratch_path(spark, "scan_csv")
    IO.write_csv(bodies(spark, sf), path)
    return IO.read_catalog_csv(spark, path, SC.CATALOGUE)


@query("scan_csv_ts", "SELECT object, datetime, r, event_type FROM ephemeris", views=["ephemeris"])
def q_scan_csv_ts(spark, sf):
    path = scratch_path(spark, "scan_csv_ts")
    IO.write_csv(ephemeris(spark, sf), path)
    return IO.read_csv_ts(spark, path, SC.EPHEMERIS)


@query("scan_csv_dir", "SELECT * FROM bodies WHERE kind IN ('a', 'c')", views=["bodies"])
def q_scan_csv_dir(spark, sf):
    base = scratch_path(spark, "scan_csv_dir")
    b = bodies(spark, sf)
    IO.write_csv(b.where(F.col("kind") == "a"), f"{base}/asteroids")
    IO.write_csv(b.where(F.col("kind") == "c"), f"{base}/comets")
    IO.write_result_json(b.where(F.col("kind") == "iso").select("spkid"), f"{base}/not_csv")
    return IO.read_csv_dir(spark, base, SC.CATALOGUE, "*.csv")


@query("scan_parquet", "SELECT spkid, e, a, v_inf FROM processed WHERE object_type = 'ISO'",
       views=["processed"], round_cols=["e", "a", "v_inf"])
def q_scan_parquet(spark, sf):
    path = scratch_path(spark, "scan_parquet")
    IO.write_catalog(processed(spark, sf), path)
    cat = spark.read.schema(SC.PROCESSED).parquet(path)
    return cat.where(F.col("object_type") == "ISO").select("spkid", "e", "a", "v_inf")


@query("sink_parquet_partitioned", "SELECT * FROM processed", views=["processed"], round_cols=PROCESSED_DOUBLES)
def q_sink_parquet_partitioned(spark, sf):
    path = scratch_path(spark, "processed")
    IO.write_catalog(processed(spark, sf), path)
    return spark.read.schema(SC.PROCESSED).parquet(path)


@query("scan_or_empty", "SELECT * FROM galaxies", views=["galaxies"])
def q_scan_or_empty(spark, sf):
    path = scratch_path(spark, "galaxies")
    galaxies(spark, sf).write.mode("overwrite").parquet(path)
    present = IO.read_or_empty(spark, path, SC.GALAXIES)
    absent = IO.read_or_empty(spark, path + "-missing", SC.GALAXIES)
    return present.unionByName(absent)


@query("scan_result_json", COMPARISON_SQL, views=["model_runs"])
def q_scan_result_json(spark, sf):
    """Indented documents of both kinds, written, read back and compared; corrupt ones beside them are skipped."""
    path = scratch_path(spark, "results")
    ml, dl = run_documents(model_runs(spark, sf))
    for name, docs in (("ml", ml), ("dl", dl)):
        IO.write_documents(docs, f"{path}/{name}/docs", "model")
        spark.createDataFrame([("{not json",)], "value string").write.mode("overwrite").text(f"{path}/{name}/corrupt")
    return run_comparison(spark, f"{path}/ml/*", f"{path}/dl/*")[0]


@query("sink_result_json", "SELECT task, approach, model, accuracy, f1, train_time, n_anomalies FROM model_runs",
       views=["model_runs"])
def q_sink_result_json(spark, sf):
    path = scratch_path(spark, "result_json")
    m = model_runs(spark, sf)
    docs = m.groupBy("approach").agg(F.collect_list(F.struct(
        "task", "model", "accuracy", "f1", "train_time", "n_anomalies")).alias("runs"))
    docs.select(F.to_json(F.struct("approach", "runs")).alias("value")).write.mode("overwrite").text(path)
    back = spark.read.text(path).select(F.from_json("value", (
        "approach string, runs array<struct<task: string, model: string, accuracy: double, f1: double, "
        "train_time: double, n_anomalies: bigint>>")).alias("d"))
    return R.records_to_rows(back.select("d.approach", "d.runs"), "runs", ["approach"]) \
        .select("task", "approach", "model", "accuracy", "f1", "train_time", "n_anomalies")


@query("json_positional_rows", "SELECT *, CAST(NULL AS VARCHAR) AS absent FROM bodies", views=["bodies"])
def q_json_positional_rows(spark, sf):
    """The whole catalogue as one document, read back by byte ranges."""
    path = scratch_path(spark, "payload")
    write_positional_payload(bodies(spark, sf), path, CATALOGUE_FIELDS, "spkid")
    rows = read_positional_payload(spark, path, [*CATALOGUE_FIELDS, "absent"])
    return cast_numeric(rows, _RAW_DOUBLES)


_DIM_VALUES = ", ".join(f"({_sql_value(r[0])}, {_sql_value(r[8])}, DATE '{r[6]}', {_sql_value(r[9])})" for r in INTERSTELLAR_ROWS)


@query("literal_rows",
       "SELECT spkid, full_name, object_type, tisserand_j, v_inf, energy_param, shape, perihelion_date, size_km FROM processed_known "
       f"LEFT JOIN (VALUES {_DIM_VALUES}) AS d(name, shape, perihelion_date, size_km) ON split_part(full_name, ' (', 1) = d.name",
       views=["processed_known"], round_cols=["tisserand_j", "v_inf", "energy_param"])
def q_literal_rows(spark, sf):
    known = IO.literal_rows(spark, KNOWN_INTERSTELLAR_ROWS, SC.CATALOGUE)
    allrows = etl_full(R.union_by_name(bodies(spark, sf), known))
    dim = interstellar_dimension(spark).select("name", "shape", "perihelion_date", "size_km")
    named = allrows.withColumn("name", F.split_part("full_name", F.lit(" ("), F.lit(1)))
    return dim_join(named, dim, "name").select("spkid", "full_name", "object_type", "tisserand_j", "v_inf", "energy_param",
                                               "shape", "perihelion_date", "size_km")


@query("sink_csv", "SELECT * FROM galaxies", views=["galaxies"])
def q_sink_csv(spark, sf):
    path = scratch_path(spark, "sink_csv")
    g = galaxies(spark, sf)
    IO.write_csv(g, path)
    IO.write_csv(g, path)  # overwrite, not append
    return IO.read_catalog_csv(spark, path, SC.GALAXIES)


@query("export_records", "SELECT full_name, object_type, e, a FROM processed", views=["processed"],
       round_cols=["e", "a"])
def q_export_records(spark, sf):
    path = scratch_path(spark, "records")
    IO.write_result_json(processed(spark, sf).select("full_name", "object_type", "e", "a"), path)
    return spark.read.schema("full_name string, object_type string, e double, a double").json(path)
