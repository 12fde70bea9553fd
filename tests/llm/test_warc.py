"""WARC round trip, roles of equal payloads, merged order, and defined cases."""

import base64
import gzip
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from astroframe.llm import warc
from astroframe.session import scratch_path
from tests.llm.conftest import rows

PAGES = "page_id long, url string, html string"


def plain(pages):
    largest = {}
    for i, _, h in pages:
        key = h or ""
        best = largest.get(key)
        largest[key] = i if best is None else best if i is None else max(best, i)
    out = []
    for i, _, h in pages:
        raw = (h or "").encode()
        top = largest[h or ""]
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        out.append((i, len(raw), digest, "response" if i == top else "revisit", None if i == top else top))
    return sorted(out, key=str)


def result(df):
    return sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in rows(df)), key=str)


def test_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    got = warc.archive_and_index(pages)
    assert result(got) == plain([(r["page_id"], r["url"], r["html"]) for r in rows(pages)])


def test_archives_hold_the_payloads(spark):
    pages = [(i, f"http://h{i % 3}.org/p", f"<p>{i % 5}\r\n\r\nWARC/1.1\r\n\n é") for i in range(40)]
    path = scratch_path(spark, "warc")
    warc.write_archive(spark.createDataFrame(pages, PAGES).withColumnsRenamed({"page_id": "id", "html": "payload"}), path, records_per_file=7)
    found = {}
    for f in spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).collect():
        raw = gzip.decompress(f["content"])
        records = list(warc.records(raw))
        assert len(records) <= 7
        for offset, length, head, body in records:
            assert raw[offset:offset + length].startswith(b"WARC/1.1\r\n") and head["Content-Length"] == str(len(body))
            found[warc._page(head["WARC-Record-ID"])] = (head["WARC-Type"], head["WARC-Target-URI"], body.decode())
    assert found == {i: ("response" if i >= 35 else "revisit", u, h if i >= 35 else "") for i, u, h in pages}


def test_histories_are_globally_ordered(spark):
    rng = random.Random(2)
    pages = [(i, rng.choice(["http://hot.org/", "http://www.B.com/x?Q=1#f", "https://a.net/%d" % rng.randint(0, 50), None]), f"page {i % 90}")
             for i in rng.sample(range(5000), 600)]
    merged = warc.archive_and_index(spark.createDataFrame(pages, PAGES).repartition(5))
    got = sorted(rows(merged), key=lambda r: (r["slice"], r["place"]))
    order = [(r["url_key"], r["ts"], r["page_id"]) for r in got]
    assert order == sorted(order) and len(order) == 600
    assert len({r["slice"] for r in got if r["url_key"] == "org,hot)/"}) > 1  # a hot URL spans slices


def test_loser_tree_merges_any_runs():
    rng = random.Random(9)
    for k in range(0, 9):
        runs = [sorted(rng.randint(0, 30) for _ in range(rng.randint(0, 12))) for _ in range(k)]
        assert list(warc.LoserTree(runs, lambda x: x)) == sorted(x for r in runs for x in r)


def test_damaged_archives_are_refused(spark):
    good = b"WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    assert [b for *_, b in warc.records(good * 2)] == [b"abc", b"abc"]
    for bad in (good[:-4], b"x" + good, good.replace(b"3", b"9")):
        with pytest.raises(ValueError):
            list(warc.records(bad))


def test_defined_cases(spark):
    pages = [(1, None, None), (2, "http://x.org", ""), (3, "::bad[", "y"), (3, "::bad[", "y"), (None, "http://x.org/a\r\nb", "y"), (None, None, "z"),
             (7, "http://x.org", "long " * 200_000), (8, "http://x.org", "long " * 200_000)]
    df = spark.createDataFrame(pages, PAGES).withColumn("id", F.lit("clash")).withColumn("run", F.lit("clash"))
    assert result(warc.archive_and_index(df)) == plain(pages)
    assert rows(warc.archive_and_index(spark.createDataFrame([], PAGES))) == []


def test_small_payloads_stay_responses(spark):
    pages = [(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcd"), (4, "u", "abcd")]
    got = result(warc.archive_and_index(spark.createDataFrame(pages, PAGES), min_bytes=3))
    assert [(r[0], r[3], r[4]) for r in got] == [(1, "response", None), (2, "response", None), (3, "revisit", 4), (4, "response", None)]
