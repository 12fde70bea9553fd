"""Packing: exact round trip, best fit against a plain search, and defined cases."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from astroframe.llm import packing
from tests.llm.conftest import rows

RANKS = open(packing.TOKENIZER, "rb").read()


def joined(packs):
    found = {}
    for r in rows(packing.unpack(packs)):
        found.setdefault(r["doc_id"], []).append((r["first"], r["piece"], r["ids"]))
    return found


def test_round_trip_of_the_whole_table(spark):
    from astroframe.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    packs = QUERIES["op2_token_packing"](spark, sf).cache()
    texts = {r["doc_id"]: r["text"] for r in rows(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text"))}
    own = packing.encoder(RANKS)
    found = joined(packs)
    assert set(found) == {d for d, t in texts.items() if t}
    for d, parts in found.items():
        parts.sort()
        assert [p[0] for p in parts] == list(range(0, parts[-1][0] + 1, packing.CAPACITY))
        assert own.decode([i for p in parts for i in p[2]]) == texts[d]
    lines = rows(packs)
    for r in lines:
        place = np.frombuffer(r["position_ids"], "<u2")
        assert len(r["input_ids"]) == len(r["position_ids"]) == 2 * packing.CAPACITY
        assert r["cu_seqlens"][-1] == r["n_tokens"] <= packing.CAPACITY
        assert np.nonzero(place[:r["n_tokens"]] == 0)[0].tolist() == r["cu_seqlens"][:-1]
    used = sum(r["n_tokens"] for r in lines)
    assert len(lines) <= 1.1 * used / packing.CAPACITY + 2


def test_best_fit_is_best_fit():
    rng = random.Random(3)
    for capacity in (1, 7, 64, 100):
        lengths = sorted((rng.randint(1, capacity) for _ in range(300)), reverse=True)
        room = []
        for n in lengths:
            fits = [x for x in room if x >= n]
            if fits:
                room[room.index(min(fits))] -= n
            else:
                room.append(capacity - n)
        got = packing.best_fit(lengths, capacity)
        assert sorted(i for r in got for i in r) == list(range(300))
        assert sorted(capacity - sum(lengths[i] for i in r) for r in got) == sorted(room)


def test_parts_encode_like_the_whole():
    own = packing.encoder(RANKS)
    text = "Ab cd, ef\n\n gh  ij 12 kl's " * 400
    for size in (5, 50, 1000):
        assert [i for p in packing.parts(text, size) for i in own.encode_ordinary(p)] == own.encode_ordinary(text)


@pytest.mark.parametrize("text", ["a" * 200_000, " " * 50_000 + "x", "\n" * 50_000, "é" * 100_000, "!" * 100_000])
def test_long_runs_are_encoded(text):
    assert packing.encoder(RANKS).decode(packing.encode(text, RANKS).tolist()) == text


def test_defined_cases(make_docs):
    docs = make_docs([(1, None), (2, ""), (3, "same text"), (3, "same text"), (None, "no id"), (4, "word " * 30_000)])
    docs = docs.withColumn("group", F.lit("clash")).withColumn("n", F.lit("clash"))
    found = joined(packing.pack(docs, capacity=128, group_tokens=2000))
    assert set(found) == {3, None, 4} and len(found[3]) == 2
    assert max(len(p[2]) for p in found[4]) <= 128
    own = packing.encoder(RANKS)
    assert own.decode([i for p in sorted(found[4]) for i in p[2]]) == "word " * 30_000
    assert rows(packing.pack(make_docs([]))) == []
    assert rows(packing.pack(make_docs([(1, None), (2, "")]))) == []


def test_written_packs_come_back(spark, make_docs):
    from astroframe.session import scratch_path

    path = scratch_path(spark, "packs")
    packs = packing.pack(make_docs([(1, "some text here"), (2, "word " * 3000), (None, "no id"), (3, None)]), capacity=256, group_tokens=2000).cache()
    packing.write_packs(packs, path)
    back = packing.read_packs(spark, path)
    assert back.columns == packs.columns and sorted(map(tuple, rows(back)), key=str) == sorted(map(tuple, rows(packs)), key=str)
    found, own = joined(back), packing.encoder(RANKS)
    assert own.decode([i for p in sorted(found[2]) for i in p[2]]) == "word " * 3000 and set(found) == {1, 2, None}


def test_the_rank_file_is_counted_once_not_for_every_text():
    class Counted(bytes):
        scans = 0

        def count(self, *args):
            Counted.scans += 1
            return super().count(*args)

    ranks = Counted(RANKS)
    for text in ("one", "two words", "", None, "three"):
        assert packing.encoder(RANKS).decode(packing.encode(text, ranks).tolist()) == (text or "")
    assert Counted.scans <= 1
