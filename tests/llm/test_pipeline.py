"""The pipeline against the plain versions of its stages, its schema, and the entry guard."""

import hashlib
import subprocess
import sys
from collections import Counter, defaultdict
from pathlib import Path

import pytest
import xxhash

import corpus_pipeline
from pyspark.sql import functions as F
from astroframe.llm import sharding
from tests.llm.conftest import rows
from tests.llm.test_decontam import plain_matches
from tests.llm.test_mixing import WORD, plain_targets
from tests.llm.test_quality import plain_hosts, plain_rules
from tests.llm.test_simhash import plain_components, plain_fingerprint

SF = "/root/testdata/sf0.001"
REPO = Path(corpus_pipeline.__file__).parent


def plain_pipeline(docs, items):
    """docs: (doc_id, text, source) with unique ids -> {doc_id: copies} of the mixed corpus."""
    failed = {d: plain_rules(t)[-1] for d, t, _ in docs}
    bad = plain_hosts([(s, failed[d]) for d, _, s in docs])
    docs = [x for x in docs if not failed[x[0]] and x[2] not in bad]
    of = plain_components({d: plain_fingerprint(t) for d, t, _ in docs})
    docs = [x for x in docs if of[x[0]] == x[0]]
    leaks = {d for d, _ in plain_matches([(d, t) for d, t, _ in docs], items)}
    docs = [x for x in docs if x[0] not in leaks]
    size = {d: len(WORD.findall(t or "")) for d, t, _ in docs}
    by = defaultdict(list)
    for d, t, s in docs:
        inner = hashlib.md5((t or "").encode()).hexdigest()
        by[s].append((int(hashlib.md5(f"17:{d}:{inner}".encode()).hexdigest()[:15], 16), d))
    totals = {s: sum(size[d] for _, d in ds) for s, ds in by.items()}
    targets, copies = plain_targets(totals), {}
    for s, ds in by.items():
        whole = int(targets[s] // totals[s]) if totals[s] else 0
        want, run = targets[s] - whole * totals[s], 0
        for _, d in sorted(ds):
            copies[d] = min(3, whole + (2 * run + size[d] <= 2 * want))
            run += size[d]
    return {d: n for d, n in copies.items() if n}


@pytest.fixture(scope="module")
def result(spark):
    return corpus_pipeline.run(spark, SF).cache()


def test_run_matches_the_plain_stages(spark, result):
    docs = [(r["doc_id"], r["text"], r["source"]) for r in rows(spark.read.parquet(f"{SF}/documents.parquet"))]
    items = [tuple(r) for r in rows(spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text"))]
    got = rows(result)
    assert Counter(r["doc_id"] for r in got) == plain_pipeline(docs, items)
    texts = {d: t for d, t, _ in docs}
    assert all(r["text"] == texts[r["doc_id"]] and r["place"]["size"] == len(r["text"].encode()) + 8 for r in got)
    counts = Counter(r["place"]["shard"] for r in got)
    assert max(counts.values()) - min(counts.values()) <= 1 and len(counts) == 24
    assert len({(r["place"]["shard"], r["place"]["slot"]) for r in got}) == len(got)


def test_shards_follow_the_ring(result):
    got = rows(result)
    order = sorted(got, key=lambda r: xxh_place(r["doc_id"]))
    want = sharding.place_cells(Counter((xxh_place(r["doc_id"]) >> 48) + sharding.CELLS // 2 for r in got), 24)
    total = Counter()
    for cell, start, shard, slot in want:
        total[shard] = max(total[shard], slot + 1)
    assert len(order) == len(got) and {r["place"]["shard"] for r in got} == set(total)


def xxh_place(doc_id):
    """Spark's xxhash64(doc_id IS NULL, doc_id): the seed runs through the columns."""
    seed = xxhash.xxh64_intdigest((0).to_bytes(4, "little"), 42)
    out = xxhash.xxh64_intdigest(doc_id.to_bytes(8, "little", signed=True), seed)
    return out - (1 << 64) if out >= 1 << 63 else out


def test_stages(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "simhash near-dedup", "benchmark decontamination", "source mixing", "sharding"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        empty = stage(spark, docs.limit(0), SF)
        assert empty.schema.names == docs.schema.names and rows(empty) == []
    assert rows(corpus_pipeline.STAGES[-1][1](spark, docs.limit(0), SF)) == []


def test_columns_of_any_name_and_long_texts_pass_through(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60).cache()
    names = ["place", "doc", "fp", "rank", "root", "row", "base", "part", "idx", "target"]
    odd = docs.unionByName(docs.limit(2).withColumns({"doc_id": F.col("doc_id") + 10**6, "text": F.concat_ws(" ", "text", F.sequence(F.lit(1), F.lit(60_000)))}))
    odd = odd.withColumns({n: F.lit(n) for n in names})
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = rows(stage(spark, odd, SF))
        assert all(r[n] == n for r in out for n in names)
    last = corpus_pipeline.STAGES[-1][1](spark, odd, SF)
    assert last.columns == [*odd.columns, "place_"] and last.count() == odd.count()


def test_entry_works_without_the_corpus_operators(tmp_path):
    """A copy of the repository without them still imports and offers its other queries."""
    for f in REPO.rglob("*.py"):
        part = f.relative_to(REPO)
        if part.parts[0] in ("astroframe", "__spark_entry__.py", "tools") and "llm" not in part.parts:
            (tmp_path / part).parent.mkdir(parents=True, exist_ok=True)
            (tmp_path / part).write_text(f.read_text())
    code = "import __spark_entry__ as e; q = e.queries(); s = e.oracle_sql(); print(len(q), 'pipeline' in q, set(s) <= set(q), any(x[:2] == 'op' for x in q))"
    said = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(tmp_path)})
    n, *rest = said.stdout.split()
    assert int(n) >= 100 and rest == ["False", "True", "False"] or pytest.fail(said.stdout + said.stderr)
