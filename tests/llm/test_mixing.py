"""Source mixing: water-filling against exact arithmetic, sampled words near the targets, defined cases."""

import re
from collections import defaultdict
from fractions import Fraction

from pyspark.sql import functions as F

from astroframe.llm import mixing
from tests.llm.conftest import rows

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_targets(sizes, weights=(1, 2, 3), cap=3):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, clamped = sum(sizes.values()), set()
    while True:
        rest = total - sum(cap * sizes[s] for s in clamped)
        free = [s for s in order if s not in clamped]
        share = Fraction(rest, sum(w[s] for s in free)) if free else 0
        new = {s for s in free if w[s] * share > cap * sizes[s]}
        if not new:
            return {s: float(cap * sizes[s]) if s in clamped else float(w[s] * share) for s in order}
        clamped |= new


def mixed(table, **opts):
    return rows(mixing.mix(table, carry=["doc_id", "source"], **opts))


def check(table, docs):
    got = mixed(table)
    sizes, taken, largest = defaultdict(int), defaultdict(int), defaultdict(int)
    for d in docs:
        n = len(WORD.findall(d[1] or ""))
        sizes[d[3]] += n
        largest[d[3]] = max(largest[d[3]], n)
    want = plain_targets(sizes)
    for r in got:
        s = r["doc"]["source"]
        assert r["source_size"] == sizes[s] and abs(r["target"] - want[s]) <= 1e-9 * max(1, want[s])
        assert r["taken"] == r["size"] * r["copies"] <= 3 * r["size"]
        taken[s] += r["taken"]
    assert len(got) == len(docs)
    for s in sizes:
        assert abs(taken[s] - want[s]) <= largest[s] / 2 + 1e-6, s
    return got


def words(n):
    return " ".join(f"w{i}" for i in range(n))


def test_clamped_and_free_sources(make_docs):
    docs = [(i, words(3 + i % 40), "en", f"s{i % 5}") for i in range(300)]
    docs += [(1000 + i, words(5), "en", "tiny") for i in range(4)] + [(2000 + i, words(7), "en", None) for i in range(30)]
    docs += [(3000 + i, words(50), "en", "Big") for i in range(200)]
    got = check(make_docs(docs), docs)
    assert {r["copies"] for r in got if r["doc"]["source"] == "tiny"} == {3}


def test_reruns_and_other_partitions_agree(make_docs):
    docs = [(i, words(i % 30), "en", f"s{i % 7}") for i in range(200)]
    first = sorted((r["doc"]["doc_id"], r["taken"]) for r in mixed(make_docs(docs)))
    assert first == sorted((r["doc"]["doc_id"], r["taken"]) for r in mixed(make_docs(docs, parts=7)))


def test_seed_changes_the_sample(make_docs):
    docs = [(i, words(10), "en", "a" if i < 40 else "b") for i in range(90)]
    one, two = (sorted((r["doc"]["doc_id"], r["taken"]) for r in mixed(make_docs(docs), seed=s)) for s in (1, 2))
    assert one != two


def test_equal_rows_share_a_source(make_docs):
    """A third of all rows equal, id included: the target is still met to half a document."""
    docs = [(1, words(20), "en", "a")] * 150 + [(i, words(15), "en", "b") for i in range(2, 300)]
    check(make_docs(docs), docs)


def test_defined_cases(make_docs):
    docs = [(1, None, "en", "a"), (2, "", "en", "a"), (None, words(4), "en", None), (3, words(200_000), "en", "b"), (4, words(3), "en", "a")]
    check(make_docs(docs), docs)
    empty = [(1, None, "en", "a"), (2, " ", "en", None)]
    assert {(r["size"], r["target"], r["taken"]) for r in mixed(make_docs(empty))} == {(0, 0.0, 0)}
    assert mixed(make_docs([])) == []


def test_repeated_gives_whole_rows(make_docs):
    docs = [(i, words(6), "en", "a" if i < 3 else "b") for i in range(60)]
    table = make_docs(docs).withColumn("h", F.lit("clash")).withColumn("copies", F.lit("clash"))
    out = mixing.repeated(table)
    assert out.columns == table.columns
    copies = {r["doc"]["doc_id"]: r["copies"] for r in mixed(table)}
    found = defaultdict(int)
    for r in rows(out):
        found[r["doc_id"]] += 1
        assert r["copies"] == "clash"
    assert dict(found) == {d: n for d, n in copies.items() if n}
    assert rows(mixing.repeated(make_docs([]))) == []
