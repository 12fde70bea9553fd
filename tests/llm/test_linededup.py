"""Line dedup against plain counting, the runs' levels, and defined cases."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from astroframe.llm import linededup
from tests.llm.conftest import rows

SPACE = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def key(line):
    return line.strip(SPACE).translate(LOWER)


def plain(texts, min_docs=10):
    counts = Counter(k for t in texts for k in {key(x) for x in (t or "").split("\n")})
    out = []
    for t in texts:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not key(x) or counts[key(x)] < min_docs]
        out.append((len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def run(table, **opts):
    return [(r["doc"]["doc_id"], r["n_lines"], r["n_dropped"], r["kept_text"])
            for r in rows(linededup.dedup_lines(table, carry=["doc_id"], **opts))]


@pytest.mark.parametrize("batches,fanout,min_docs", [(4, 2, 10), (5, 3, 2), (1, 2, 3), (7, 2, 10)])
def test_matches_plain_counting(make_docs, batches, fanout, min_docs):
    rng = random.Random(batches)
    pool = ["Privacy Policy", " privacy policy\t", "ÉTÉ", "été", "", " ", "Share", "a\rb", "x" * 500] + [f"line {i}" for i in range(120)]
    texts = ["\n".join(rng.choice(pool) for _ in range(rng.randint(0, 12))) for _ in range(150)] + [None, "", "\n\n"]
    got = run(make_docs(list(enumerate(texts))), batches=batches, fanout=fanout, min_docs=min_docs)
    assert sorted(got) == [(i, *w) for i, w in enumerate(plain(texts, min_docs))]


def test_repeated_rows_and_ties(make_docs):
    """Ten equal rows make a line frequent; nine don't; a line counts once per row."""
    nine, ten = [(1, "only nine\nother 1")] * 9, [(2, "ten times\nten times\nrest")] * 10
    got = run(make_docs(nine + ten + [(None, "ten times"), (3, "only nine " * 0 + "solo")]))
    assert sorted(x for x in got if x[0] == 1) == [(1, 2, 0, "only nine\nother 1")] * 9
    assert [x for x in got if x[0] == 2] == [(2, 3, 3, "")] * 10
    assert (None, 1, 1, "") in got and (3, 1, 0, "solo") in got


def test_long_text_extra_columns_and_empty_table(make_docs):
    long = "\n".join(f"row {i % 5000}" for i in range(40_000))
    table = make_docs([(i, "shared\nx" + str(i)) for i in range(12)] + [(99, long)]).withColumn("pos", F.lit("clash")).withColumn("k1", F.lit("clash"))
    out = {r["doc"]["doc_id"]: r for r in rows(linededup.dedup_lines(table))}
    assert out[3]["kept_text"] == "x3" and out[3]["doc"]["pos"] == "clash"
    assert (out[99]["n_lines"], out[99]["n_dropped"]) == (40_000, 0)
    assert run(make_docs([])) == []


def test_runs_are_levelled_and_compacted(spark):
    runs = linededup.LineRuns(spark, min_docs=3, fanout=2)
    seen = Counter()
    rng = random.Random(1)
    for b in range(6):
        batch = [(rng.randint(0, 40), 7) for _ in range(25)]
        seen.update(batch)
        runs.add(spark.createDataFrame(batch, "h1 long, h2 long"))
        assert all(len(level) < 2 for level in runs.levels)
        assert {tuple(r) for r in rows(runs.frequent())} == {k for k, n in seen.items() if n >= 3}
    assert [len(level) for level in runs.levels] == [0, 1, 1]


def test_batch_joins_the_runs_without_exchange(spark):
    runs = linededup.LineRuns(spark, min_docs=2, fanout=2)
    for _ in range(2):
        runs.add(spark.range(30).selectExpr("id AS h1", "id AS h2"))
    plan = runs.frequent_runs[0].groupBy("h1", "h2").count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_main_path_has_no_python(make_docs):
    plan = linededup.dedup_lines(make_docs([(1, "a\nb")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_a_text_of_very_many_lines(make_docs):
    """Half of 200,000 lines of one text go: linear in their number."""
    common = [f"common {i}" for i in range(50)]
    long = "\n".join(common[i % 50] if i % 2 else f"own {i}" for i in range(200_000))
    docs = [(0, long)] + [(i, "\n".join(common)) for i in range(1, 11)]
    got = {r["doc"]["doc_id"]: r for r in linededup.dedup_lines(make_docs(docs)).collect()}
    assert got[0]["n_lines"] == 200_000 and got[0]["n_dropped"] == 100_000
    assert got[0]["kept_text"] == "\n".join(f"own {i}" for i in range(0, 200_000, 2))
    assert got[3]["kept_text"] == "" and got[3]["n_dropped"] == 50
