"""Merkle manifest: against a plain recursive tree, over several block sizes, and the defined cases."""

import hashlib
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from astroframe.llm import merkle
from tests.llm.conftest import DOCS


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def enc(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf(d, more=0):
    doc_id, text, lang, source, n = d
    return sha("".join(map(enc, (doc_id, source, lang, n if n is None else n + more, text))))


def tree(digests):
    """(root, proof of each leaf), level by level."""
    proofs, at, level = [[] for _ in digests], list(range(len(digests))), list(digests)
    while len(level) > 1:
        for i, p in enumerate(at):
            pair = level[p & ~1:(p & ~1) + 2]
            proofs[i].append("." if len(pair) == 1 else "R" + pair[1] if p % 2 == 0 else "L" + pair[0])
        level = [sha("".join(level[i:i + 2])) for i in range(0, len(level), 2)]
        at = [p >> 1 for p in at]
    return level[0], proofs


def fold(digest, proof):
    for s in proof:
        digest = sha(s[1:] + digest if s[0] == "L" else digest + s[1:] if s[0] == "R" else digest)
    return digest


def plain(docs):
    by = defaultdict(list)
    for d in docs:
        by[d[2]].append(d)
    langs = sorted(by, key=lambda x: (x is not None, (x or "").encode()))
    for ds in by.values():
        ds.sort(key=lambda d: (d[0] is not None, d[0] or 0, leaf(d)))
    trees = {x: tree([leaf(d) for d in by[x]]) for x in langs}
    root, tops = tree([trees[x][0] for x in langs])
    out = []
    for x, top in zip(langs, tops):
        for d, own in zip(by[x], trees[x][1]):
            proof = own + top
            hit = d[0] is not None and zlib.crc32(str(d[0]).encode()) % 7 == 0
            end = fold(leaf(d, 1 if hit else 0), proof)
            out.append((d[0], leaf(d), trees[x][0], root, sha("".join(s.strip("LR.") for s in proof)), end, end == root))
    return sorted(out, key=repr)


def got(df, **options):
    out = merkle.verified_manifest(df, carry=["doc_id"], **options)
    rows = out.select("doc.doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()
    return sorted(map(tuple, rows), key=repr)


def table(spark, docs, parts=3):
    return spark.createDataFrame(docs, DOCS).repartition(parts)


@pytest.mark.parametrize("block", [1, 2, 3, 10])
def test_equals_the_plain_tree(spark, block):
    docs = [(i * 7 % 90, f"text {i}", ["en", "de", None, "é", "z"][i % 5 if i < 60 else 0], f"s{i % 3}", i) for i in range(83)]
    assert got(table(spark, docs), block=block) == plain(docs)


def test_nulls_ties_repeats_and_long_texts(spark):
    docs = [(None, None, None, None, None), (None, "", None, "", 0), (1, "x" * 300_000, "en", "a:b", 300_000), (1, "y", "en", "a", 1)]
    docs += [(5, "same", "en", "s", 4)] * 40 + [(7, "max", "fr", "s", 2**63 - 1), (14, None, "fr", None, None)]
    assert got(table(spark, docs), block=3) == plain(docs)


def test_single_and_empty(spark):
    one = [(3, "a", "en", "s", 1)]
    assert got(table(spark, one)) == plain(one)
    assert got(table(spark, [])) == []


def test_clashing_columns_and_whole_rows(spark):
    docs = [(i, f"t{i}", "en", "s", i) for i in range(9)]
    extra = table(spark, docs).withColumns({c: F.lit("mine") for c in ("tree", "place", "digest", "rest", "part", "idx", "n", "leaf", "key")})
    out = merkle.manifest(extra, block=2).collect()
    assert {r["doc"]["tree"] for r in out} == {"mine"} and len(out) == 9
    assert all(fold(r["leaf"], r["proof"]) == r["root"] for r in out)


def test_tampering_is_found(spark):
    docs = [(i, f"t{i}", "en", "s", i) for i in range(60)]
    rows = got(table(spark, docs))
    assert {r[0] for r in rows if not r[6]} == {i for i in range(60) if zlib.crc32(str(i).encode()) % 7 == 0}
