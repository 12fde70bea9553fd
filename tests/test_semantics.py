"""Edge semantics of the cleaning / feature / classification operators."""

import math

import pytest
from pyspark.sql import functions as F

from astroframe import schema as SC
from astroframe.constants import CATALOGUE_FIELDS, KNOWN_INTERSTELLAR_ROWS
from astroframe.functions import columns as C
from astroframe.operators import classify as K
from astroframe.operators.features import etl_full
from astroframe.session import scratch_path
from astroframe.sources import catalog_io as IO


def raw(spark, rows):
    return IO.literal_rows(spark, rows, SC.CATALOGUE)


def base(**kw):
    r = {c: None for c in CATALOGUE_FIELDS}
    r.update(spkid="1", full_name="x", kind="a", **{"class": "MBA"}, e=0.1, a=2.5, i=10.0, q=2.25, H=15.0,
             diameter=1.0)
    r.update(kw)
    return r


def test_known_interstellar_rows(spark):
    out = {r["spkid"]: r for r in etl_full(raw(spark, KNOWN_INTERSTELLAR_ROWS)).collect()}
    a, b = out["3788040"], out["3788041"]
    assert a["object_type"] == b["object_type"] == "ISO"
    assert round(a["energy_param"], 6) == 0.390656 and round(b["energy_param"], 6) == 0.587268
    assert round(a["v_inf"], 3) == 26.323 and round(b["v_inf"], 3) == 32.274
    assert a["tisserand_j"] is None and b["tisserand_j"] is None  # S5


def test_nan_and_empty_csv_cells_become_null(spark):  # S1
    path = scratch_path(spark, "t_csv")
    spark.createDataFrame([("1", "NaN", ""), ("2", "1.5", "2")], "spkid string, e string, a string") \
        .write.option("header", True).csv(path)
    df = IO.read_catalog_csv(spark, path, "spkid string, e double, a double").orderBy("spkid").collect()
    assert df[0]["e"] is None and df[0]["a"] is None
    assert df[1]["e"] == 1.5 and df[1]["a"] == 2.0


def test_try_cast_and_guarded_division(spark):  # S3, S4
    df = spark.createDataFrame([("5-LOW", 0.0), ("2.5", 2.0)], "s string, a double")
    r = df.select(C.to_double("s").alias("x"), C.safe_div(F.lit(1.0), "a").alias("y")).collect()
    assert r[0]["x"] is None and r[0]["y"] is None
    assert r[1]["x"] == 2.5 and r[1]["y"] == 0.5


def test_clamp_keeps_null_and_cleaning(spark):  # S6, S2
    rows = [base(spkid="1", i=None), base(spkid="2", i=200.0), base(spkid="3", i=-3.0),
            base(spkid="4", H=40.0, diameter=0.0), base(spkid="5", e=-0.1), base(spkid="6", a=None)]
    out = {r["spkid"]: r for r in etl_full(raw(spark, rows)).collect()}
    assert set(out) == {"1", "2", "3", "4"}
    assert out["1"]["i"] is None and out["1"]["tisserand_j"] is None
    assert out["2"]["i"] == 180.0 and out["3"]["i"] == 0.0
    assert out["4"]["H"] is None and out["4"]["diameter"] is None


def test_class_mapping_and_overrides(spark):  # S7, S8, S9
    rows = [base(spkid="1", **{"class": "HYP"}, e=0.5), base(spkid="2", **{"class": "TJN"}),
            base(spkid="3", **{"class": None}), base(spkid="4", **{"class": "APO"}, e=1.2, a=-1.0, q=0.2),
            base(spkid="5", kind="iso", **{"class": "MBA"}), base(spkid="6", **{"class": "JFc"})]
    out = {r["spkid"]: r["object_type"] for r in etl_full(raw(spark, rows)).collect()}
    assert out == {"1": "ISO", "2": "TJN", "3": None, "4": "ISO", "5": "ISO", "6": "COM"}


def test_zero_semi_major_axis(spark):  # S4
    out = etl_full(raw(spark, [base(a=0.0, q=0.0)])).first()
    assert out["energy_param"] is None and out["q_over_a"] is None and out["tisserand_j"] is None
    assert out["v_inf"] == 0.0


def test_cut_bins_right_closed(spark):  # S10
    df = spark.createDataFrame([(0.0,), (0.05,), (0.0500001,), (10.0,), (11.0,), (None,)], "z double")
    out = [r["c"] for r in K.cut_bins(df, "z", [0, 0.05, 0.1, 0.2, 0.5, 10],
                                      ["nearby", "low_z", "mid_z", "high_z", "distant"], "c").collect()]
    assert out == ["nan", "nearby", "low_z", "distant", "nan", "nan"]


def test_population_std_scaling(spark):  # S12
    from astroframe.models.prep import standardize

    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "x double, y double")
    r = sorted(standardize(df, ["x", "y"]).collect(), key=lambda r: r["x"])
    assert r[0]["x"] == -1.0 and r[1]["x"] == 1.0  # population std = 1
    assert r[0]["y"] == 0.0  # zero deviation divides by 1


def test_tri_state_all_detected(spark):  # S17
    from astroframe.operators.aggregate import all_detected

    df = spark.createDataFrame([("a", "ISO", True), ("a", "MBA", False), ("b", "MBA", True),
                                ("c", "ISO", False)], "g string, t string, f boolean")
    out = {r["g"]: r["d"] for r in df.groupBy("g").agg(all_detected(F.col("f"), F.col("t") == "ISO").alias("d"))
           .collect()}
    assert out == {"a": True, "b": None, "c": False}


def test_required_columns(spark):  # S19
    df = spark.createDataFrame([(0.1, 2.0)], "e double, a double")
    with pytest.raises(ValueError):
        etl_full(df)


def test_rounded_is_ieee_deterministic(spark):
    df = spark.createDataFrame([(2.0442625,), (-1e-9,), (None,)], "x double")
    r = [row["y"] for row in df.select(C.rounded("x", 6).alias("y")).collect()]
    assert r[0] == math.floor(2.0442625 * 1e6 + 0.5) / 1e6
    assert r[1] == 0.0 and math.copysign(1, r[1]) == 1.0 and r[2] is None


def test_label_dim_keeps_unmatched_and_null_codes(spark):
    from astroframe.operators import classify as KK

    df = spark.createDataFrame([("MBA",), ("ISO",), ("XYZ",), (None,)], "object_type string")
    got = {r["object_type"]: r["description"] for r in KK.label_dim(df, KK.class_dimension(spark), "object_type").collect()}
    assert got["MBA"] == "Main Belt Asteroid" and got["XYZ"] is None and got[None] is None


def test_rounded_goes_on_while_there_is_a_fraction(spark):
    df = spark.createDataFrame([(1.5e12 + 0.2507,), (1e300,), (float("inf"),)], "x double")
    got = [r["y"] for r in df.select(C.rounded("x", 2).alias("y")).collect()]
    assert got[0] == math.floor((1.5e12 + 0.2507) * 100 + 0.5) / 100 and got[1:] == [1e300, math.inf]


def test_read_or_empty_missing_path(spark):
    path = scratch_path(spark, "absent")
    df = IO.read_or_empty(spark, path, "a long, b string")
    assert df.count() == 0 and df.columns == ["a", "b"]
    docs = IO.read_result_json(spark, path + "/*", "approach string")
    assert docs.count() == 0
