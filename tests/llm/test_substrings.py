"""Repeated-substring removal against counting every window, and defined cases."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from astroframe.llm import substrings
from tests.llm.conftest import rows


def plain(texts, length):
    raws = [(t or "").encode() for t in texts]
    seen = Counter(r[i:i + length] for r in raws for i in range(len(r) - length + 1))
    out = []
    for r in raws:
        gone = bytearray(len(r))
        for i in range(len(r) - length + 1):
            if seen[r[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        runs = sum(gone[i] and not (i and gone[i - 1]) for i in range(len(r)))
        out.append((len(r), sum(gone), runs, bytes(b for b, x in zip(r, gone) if not x)))
    return out


def run(table, **opts):
    return sorted((r["doc"]["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"]))
                  for r in rows(substrings.remove_repeated(table, carry=["doc_id"], **opts)))


def words(rng, n):
    return " ".join("".join(rng.choice("abcdeéß") for _ in range(rng.randint(1, 7))) for _ in range(n))


def test_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    docs = [(r["doc_id"], r["text"]) for r in rows(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text"))]
    from astroframe.llm.queries import QUERIES

    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"]) for r in rows(QUERIES["op9_suffix_dedup"](spark, sf))}
    assert got == {d: w[:3] for (d, _), w in zip(docs, plain([t for _, t in docs], 400))}
    assert any(v[1] for v in got.values())


@pytest.mark.parametrize("length,seed", [(64, 1), (100, 2), (400, 3)])
def test_copies_near_copies_passages_and_periods(make_docs, length, seed):
    rng = random.Random(seed)
    passage, base = words(rng, length // 2), words(rng, 2 * length)
    texts = [words(rng, rng.randint(1, length)) for _ in range(12)]
    texts += [base] * 3
    for _ in range(25):  # near copies: a few letters changed
        t = list(base)
        for _ in range(rng.randint(1, 6)):
            t[rng.randrange(len(t))] = "X"
        texts.append("".join(t))
    texts += [words(rng, 20) + passage[rng.randint(0, 30):len(passage) - rng.randint(0, 30)] + words(rng, 20) for _ in range(10)]
    texts += ["be " * length, "ab" * length, "z" * (3 * length), "q" * (length - 1), words(rng, 30) + "be " * length]
    texts += [passage + words(rng, 5) + passage, passage[:length], None, ""]
    texts += [passage[:len(passage) // 2] + "!" + passage[len(passage) // 2:]]
    got = run(make_docs(list(enumerate(texts))), length=length)
    assert got == sorted((i, *w) for i, w in enumerate(plain(texts, length)))


def test_long_texts_are_parsed_in_pieces(monkeypatch):
    rng = random.Random(8)
    text = words(rng, 3000).encode()
    whole = {(k, a) for k, at in substrings.phrases(text, 100).items() for a in at}
    monkeypatch.setattr(substrings, "PIECE", 500)
    pieces = {}
    for (core, lo, hi, span), at in substrings.phrases(text, 100).items():
        for a in at:
            pieces.setdefault((core, a), []).append((lo, hi))
    for (core, lo, hi, span), a in whole:  # a phrase that a piece's end cuts is covered by its parts
        cover = sorted(pieces[core, a])
        assert cover[0][0] == lo and cover[-1][1] == hi and all(x[1] + 1 == y[0] for x, y in zip(cover, cover[1:]))


def test_equal_rows_extra_columns_and_empty_table(make_docs):
    rng = random.Random(4)
    twice, once = words(rng, 100), words(rng, 100)
    table = make_docs([(1, twice), (1, twice), (None, once), (2, "short"), (2, "short")]).withColumn("core", F.lit("clash")).withColumn("k1", F.lit("clash"))
    got = sorted((str(r["doc"]["doc_id"]), r["doc"]["core"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in rows(
        substrings.remove_repeated(table, length=100)))
    n = len(twice.encode())
    assert got == sorted([("1", "clash", n, 1, b"")] * 2 + [("None", "clash", 0, 0, once.encode())] + [("2", "clash", 0, 0, b"short")] * 2)
    assert run(make_docs([])) == []
    assert run(make_docs([(1, None)])) == [(1, 0, 0, 0, b"")]
