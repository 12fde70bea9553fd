"""SimHash near-dedup against brute force over all pairs, and its defined cases."""

import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from astroframe.llm import simhash
from tests.llm.conftest import rows


def plain_fingerprint(text, k=3):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in lowered.translate({ord(c): " " for c in "\t\n\x0b\x0c\r"}).split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, r=2):
    """ids -> smallest reachable id, by all pairs of different fingerprints."""
    distinct = np.array(sorted({p for p in prints.values()}), dtype=np.uint64)
    parent = list(range(len(distinct)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i, p in enumerate(distinct):
        for j in np.nonzero(np.bitwise_count(distinct[i + 1:] ^ p) <= r)[0]:
            parent[find(i)] = find(int(j) + i + 1)
    at = {int(p): i for i, p in enumerate(distinct)}
    least = {}
    for d, p in prints.items():
        root = find(at[p])
        least[root] = min(d, least.get(root, d))
    return {d: least[find(at[p])] for d, p in prints.items()}


def test_whole_table_matches_brute_force(spark):
    from astroframe.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    got = rows(QUERIES["op7_simhash_near_dedup"](spark, sf))
    texts = {r["doc_id"]: r["text"] for r in rows(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text"))}
    prints = {d: plain_fingerprint(t) for d, t in texts.items()}
    want = plain_components(prints)
    assert {r["doc_id"]: r["fingerprint"] for r in got} == {d: f"{p:016x}" for d, p in prints.items()}
    assert {r["doc_id"]: r["component_id"] for r in got} == want


def test_links_equal_brute_force_with_crowded_values(spark):
    """Clouds of fingerprints around a centre: many share a segment value, chains cross it."""
    rng = random.Random(5)
    prints = {}
    for centre in [rng.getrandbits(64) for _ in range(3)]:
        for _ in range(250):
            p = centre
            for b in rng.sample(range(64), rng.randint(0, 4)):
                p ^= 1 << b
            prints[len(prints)] = p
    for _ in range(200):
        prints[len(prints)] = rng.getrandbits(64)
    prints[len(prints)] = 0
    prints[len(prints)] = 3
    signed = [(d, p - (1 << 64) if p >= 1 << 63 else p) for d, p in prints.items()]
    df = spark.createDataFrame(signed, "doc_id long, fp long").repartition(4)
    want = plain_components(prints)
    for bucket in (4, 1000):
        of = {r["fp"]: r["component_id"] for r in rows(simhash.cluster(df, "doc_id", bucket=bucket))}
        assert {d: of[p] for d, p in signed} == want


def test_wider_distance_and_more_segments(spark):
    rng = random.Random(6)
    base = [rng.getrandbits(64) for _ in range(40)]
    prints = {i: p for i, p in enumerate(base + [p ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 7))) for p in base * 5])}
    signed = [(d, p - (1 << 64) if p >= 1 << 63 else p) for d, p in prints.items()]
    df = spark.createDataFrame(signed, "doc_id long, fp long")
    of = {r["fp"]: r["component_id"] for r in rows(simhash.cluster(df, "doc_id", max_bits=5, segments=4))}
    assert {d: of[p] for d, p in signed} == plain_components(prints, 5)


def test_long_chain_is_one_component(spark):
    chain, p = [], 0
    for b in range(0, 60, 2):
        chain.append(p)
        p ^= 3 << b
    df = spark.createDataFrame([(100 + i, x) for i, x in enumerate(chain)], "doc_id long, fp long")
    assert {r["component_id"] for r in rows(simhash.cluster(df))} == {100}


def test_defined_cases(make_docs):
    long = "lorem ipsum dolor " * 50_000
    docs = make_docs([(5, None), (3, ""), (9, " \t\n"), (1, "one two"), (2, "ONE  two"), (7, "a b c d e f"), (7, "a b c d e f"),
                      (None, "a b c d e f"), (None, "only ids that are null"), (11, long), (12, long)])
    got = [(r["doc_id"], r["fingerprint"], r["component_id"]) for r in rows(simhash.near_duplicates(docs))]
    assert len(got) == 11
    of = {d: (f, c) for d, f, c in got if d is not None}
    assert of[5] == of[3] == of[9] == ("0" * 16, 3)
    assert of[1][1] == of[2][1] == 1 and of[1][0] == of[2][0]
    assert of[7][1] == 7 and of[12][1] == of[11][1] == 11
    assert sorted(c is None for d, _, c in got if d is None) == [False, True]


def test_one_row_per_group_keeps_columns(make_docs):
    docs = make_docs([(5, None), (3, ""), (7, "a b c d e f"), (7, "a b c d e f"), (8, "A b c d e f"), (1, "something else here now")])
    docs = docs.withColumn("fp", F.lit("clash")).withColumn("row", F.lit(1)).withColumn("root", F.lit(2))
    out = simhash.one_per_group(docs)
    assert out.columns == docs.columns
    assert sorted((r["doc_id"], r["fp"]) for r in rows(out)) == [(1, "clash"), (3, "clash"), (7, "clash")]


def test_empty_table(make_docs):
    assert rows(simhash.near_duplicates(make_docs([]))) == []
    assert rows(simhash.one_per_group(make_docs([]))) == []
