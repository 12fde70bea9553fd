"""Host-level quality rules against a plain Python version, and defined cases."""

import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from astroframe.llm import quality
from tests.llm.conftest import rows

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_rules(text):
    t = text or ""
    words = WORD.findall(t)
    windows = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    covered = {p for i in range(len(words) - 4) if windows[tuple(words[i:i + 5])] > 1 for p in range(i, i + 5)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    n = len(words)
    return (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered),
            n < 10 or 100 * len(covered) > 20 * n)


def plain_hosts(docs):
    """docs: (host, failed) -> rejected hosts, by the moment estimate in the operator's text."""
    n, k = defaultdict(int), defaultdict(int)
    for host, failed in docs:
        if host is not None:
            n[host] += 1
            k[host] += failed
    total, fails = sum(n.values()), sum(k.values())
    if not fails:
        return set()
    m = fails / total
    s = sum(n[h] * (k[h] / n[h] - m) ** 2 for h in n)
    room = total - sum(x * x for x in n.values()) / total - (len(n) - 1)
    rho = (s / (m * (1 - m)) - (len(n) - 1)) / room if m < 1 and room > 0 else 0
    weight = max(0.0, (1 - rho) / rho) if rho > 0 else None
    rate = {h: m if weight is None else (k[h] + m * weight) / (n[h] + weight) for h in n}
    return {h for h in n if rate[h] > 0.5}


def check(docs, table):
    got = {(r["doc"]["doc_id"], i): tuple(r[c] for c in [*quality.RULE_COLUMNS, "kept"])
           for i, r in enumerate(sorted(rows(quality.judge(table, carry=["doc_id"])), key=lambda r: r["doc"]["doc_id"]))}
    want = {}
    bad = plain_hosts([(d[3], plain_rules(d[1])[-1]) for d in docs])
    for i, d in enumerate(sorted(docs, key=lambda d: d[0])):
        rules = plain_rules(d[1])
        want[d[0], i] = (*rules, not rules[-1] and d[3] not in bad)
    assert got == want
    return bad


def random_docs(n, seed):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(60)] + ["#a", "*", "é€", "<b>"]
    docs = []
    for i in range(n):
        host = rng.choice(["good", "mixed", "bad", "bad", f"tiny{i % 7}", None])
        words = [rng.choice(vocab) for _ in range(rng.randint(0, 60))]
        if host == "bad" and rng.random() < 0.9 or rng.random() < 0.1:
            words = words[:9] * rng.randint(1, 4)
        docs.append((i, rng.choice(["", " ", "\t"]) + "".join(w + rng.choice([" ", " ", "\n", "\x0b", "\r\n"]) for w in words), "en", host))
    return docs


@pytest.mark.parametrize("seed", [1, 2])
def test_rules_and_hosts_match_the_plain_version(make_docs, seed):
    docs = random_docs(400, seed)
    assert "bad" in check(docs, make_docs(docs)) and "good" not in check(docs, make_docs(docs))


def test_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    table = spark.read.parquet(f"{sf}/documents.parquet")
    check([(r["doc_id"], r["text"], None, r["source"]) for r in rows(table)], table)


def test_clean_documents_of_clean_hosts_stay(make_docs):
    docs = [(i, " ".join(f"w{i}x{j}" for j in range(30)), "en", f"h{i % 20}") for i in range(200)]
    docs += [(1000 + i, "too short", "en", f"h{i % 20}") for i in range(20)]
    kept = {r["doc_id"] for r in rows(quality.keep_good(make_docs(docs)))}
    assert kept == set(range(200))


def test_defined_cases(make_docs):
    long = " ".join(f"w{i}" for i in range(60_000))
    docs = [(1, None, "en", None), (2, "", "en", "h"), (3, long, "en", None), (4, long + " " + long, None, "h"), (5, "a b " * 40, "en", "h"),
            (6, "a b c d e f g h i j", "en", "k"), (6, "a b c d e f g h i j", "en", "k")]
    table = make_docs(docs).withColumn("kept", F.lit("clash")).withColumn("host", F.lit("clash")).withColumn("n_words", F.lit(1))
    check(docs, table)
    kept = quality.keep_good(table)
    assert kept.columns == table.columns
    assert sorted(r["doc_id"] for r in rows(kept)) == [3, 6, 6]


def test_empty_table(make_docs):
    assert rows(quality.judge(make_docs([]))) == []
    assert rows(quality.keep_good(make_docs([]))) == []


def test_main_path_has_no_python(make_docs):
    plan = quality.judge(make_docs([(1, "a b c")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
