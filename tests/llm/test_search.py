"""Ranked search: against a plain evaluation of the formula, with pruning at work, and the defined cases."""

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from astroframe.llm import search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def plain(docs, items, k):
    counts = [Counter(terms(t)) for _, t in docs]
    full = [c.total() for c in counts if c]
    n_docs, n_terms = len(full), sum(full)
    df = Counter(t for c in counts for t in c)
    out = []
    for item_id, text in items:
        scored = []
        for (doc_id, _), c in zip(docs, counts):
            if c:
                m = 50 + (50 * c.total() * n_docs) // n_terms
                s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m))
                        for t in set(terms(text)) if c[t])
                if s > 0:
                    scored.append((-s, doc_id is None, doc_id or 0, doc_id))
        out += [(item_id, i + 1, x[3], -x[0]) for i, x in enumerate(sorted(scored, key=lambda x: x[:3])[:k])]
    return sorted(out, key=repr)


def got(spark, docs, items, parts=3, **options):
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(parts).withColumns({c: F.lit(1) for c in ("slice", "term", "block", "rank", "score")})
    i = spark.createDataFrame(items, "item_id long, text string").withColumns({c: F.lit("x") for c in ("part", "idx", "item", "term")})
    return sorted(map(tuple, search.search(d, i, **options).collect()), key=repr)


def zipf(rng, n, vocabulary=400):
    return " ".join(f"w{int(vocabulary ** rng.random())}" for _ in range(n))


@pytest.mark.parametrize(("owners", "slice_docs", "item_block"), [(1, 4096, 256), (4, 37, 256), (6, 11, 3)])
def test_equals_the_formula(spark, owners, slice_docs, item_block):
    rng = random.Random(5)
    docs = [(i * 3 % 500, zipf(rng, rng.randint(0, 60))) for i in range(500)]
    items = [(i, zipf(rng, 12)) for i in range(8)]
    docs += [(1000 + i, items[i % 8][1] + " und mehr") for i in range(40)]
    assert got(spark, docs, items, k=10, owners=owners, slice_docs=slice_docs, item_block=item_block) == plain(docs, items, 10)


def test_ties_repeats_and_a_common_term(spark):
    docs = [(i % 30, "common same words") for i in range(200)] + [(None, "common same words"), (None, None), (7, ""), (8, "other, OTHER")]
    docs += [(100 + i, f"common filler{i}") for i in range(60)]
    items = [(1, "Common same"), (1, "Common same"), (2, None), (None, "other"), (3, "absent"), (4, "common common")]
    assert got(spark, docs, items, k=50, slice_docs=16) == plain(docs, items, 50)
    assert got(spark, docs, items, k=50, slice_docs=16) == got(spark, docs, items, k=50, parts=1)


def test_terms_and_long_texts(spark):
    docs = [(1, "Ärger ÄRGER ärger x-ray_x 12a" * 3), (2, "x " * 1_300_000 + "needle"), (3, "z\x00y{q}|É"), (4, "needle x")]
    items = [(1, "ärger"), (2, "needle"), (3, "É q y"), (4, "X RAY")]
    assert got(spark, docs, items, k=5) == plain(docs, items, 5)


def test_empty_tables(spark):
    assert got(spark, [], [(1, "a")]) == []
    assert got(spark, [(1, "a")], []) == []
    assert got(spark, [(1, None)], [(1, "a")]) == []
