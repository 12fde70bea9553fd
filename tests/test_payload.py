"""Positional payloads read by byte ranges: brackets and quotes in strings, every split size, key orders, defined cases."""

import json
import random

import pytest
from pyspark.sql import functions as F

from astroframe.sources import payload
from astroframe.sources.payload import read_positional_payload, write_positional_payload


@pytest.fixture
def small_splits(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "97b", "spark.sql.files.openCostInBytes": "0", "spark.sql.files.minPartitionNum": "1"}
    old = {k: spark.conf.get(k, None) for k in keys}
    yield lambda size: [spark.conf.set(k, v) for k, v in (keys | {"spark.sql.files.maxPartitionBytes": f"{size}b"}).items()]
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def write(path, text):
    path.mkdir(exist_ok=True)
    (path / f"doc{len(list(path.iterdir()))}.json").write_text(text)
    return str(path)


def got(spark, path, cols):
    return sorted((tuple(r) for r in read_positional_payload(spark, path, cols).collect()), key=repr)


NASTY = ["a", "", "x]y", "],[", '"', '\\"]', "\\", '"data": [[', "[[", "]]]", "é]", None, 12.5, True, "line\nbreak]", "{}", "end\\\\"]


@pytest.mark.parametrize("size", [23, 64, 301, 1 << 20])
def test_rows_whatever_the_splits(spark, small_splits, tmp_path, size):
    rng = random.Random(size)
    rows = [[f"id{i}", rng.choice(NASTY), rng.choice(NASTY)] for i in range(60)]
    doc = {"signature": {"version": "1]", "list": [1, 2]}, "fields": ["id", "a", "b"], "data": rows, "count": 60, "more": ["z"]}
    path = write(tmp_path / "one", json.dumps(doc, indent=rng.choice([None, 2])))
    small_splits(size)

    def text(v):
        return v if v is None or isinstance(v, str) else json.dumps(v)

    want = sorted(((text(r[2]), r[0], text(r[1]), None) for r in rows), key=repr)
    assert got(spark, path, ["b", "id", "a", "absent"]) == want
    if size < 100:
        assert spark.read.option("lineSep", "]").text(path).rdd.getNumPartitions() > 10


def test_key_orders_and_empty_documents(spark, tmp_path):
    path = write(tmp_path / "many", '{"data" : [ ["1","2"] , [ "3" ] ],"fields":["p","q"]}')
    write(tmp_path / "many", '{"fields":["q","p"],"data":[], "more": [["5"], ["6"]]}')
    write(tmp_path / "many", '{"fields":["q","p"]}')
    write(tmp_path / "many", '{"data":[["9"]]}')
    write(tmp_path / "many", '\n{"fields" :\n["q","p"],\n"data": [\n["8", null]\n]\n}\n')
    assert got(spark, path, ["p", "q"]) == sorted([("1", "2"), ("3", None), (None, "8")], key=repr)


def test_written_documents_come_back(spark, small_splits, tmp_path):
    rows = [(i, NASTY[i % len(NASTY)] if isinstance(NASTY[i % len(NASTY)], str) else None, i / 3) for i in range(200)]
    df = spark.createDataFrame(rows, "k long, s string, x double").repartition(4)
    write_positional_payload(df, str(tmp_path / "doc"), ["k", "s", "x"], "k")
    small_splits(500)
    back = read_positional_payload(spark, str(tmp_path / "doc"), ["k", "s", "x"]).collect()
    assert sorted((int(r["k"]), r["s"], float(r["x"])) for r in back) == sorted(rows, key=lambda r: r[0])


def test_a_document_is_in_the_order_of_its_key_and_no_task_sorts_all_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(payload, "RANGE_ROWS", 1000)
    df = spark.range(30_000).select(F.expr("(id * 7919) % 30000").alias("k"), F.repeat(F.lit("x"), 20).alias("s")).repartition(5)
    ranges = payload.in_ranges(df, 30_000, "k")
    sizes = ranges.groupBy(F.spark_partition_id()).count().agg(F.max("count"), F.count("*")).first()
    assert sizes[0] < 3000 and sizes[1] > 10
    write_positional_payload(df, str(tmp_path / "doc"), ["k", "s"], "k")
    [line] = spark.read.text(str(tmp_path / "doc"), wholetext=True).collect()
    assert [int(r[0]) for r in json.loads(line.value)["data"]] == list(range(30_000))
