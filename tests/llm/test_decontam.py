"""Benchmark decontamination: planted passages, re-parameterised questions, clean documents, defined cases."""

import random
import re

from pyspark.sql import functions as F

from astroframe.llm import decontam
from tests.llm.conftest import rows

ITEMS = "item_id long, text string"


def plain_tokens(text):
    return [t for w in (text or "").split() if (t := re.sub(r"^\W+|\W+$", "", w).lower())]


def plain_matches(docs, items, window=5):
    """(doc, item) whose windows are covered to 0.8 by one stretch; for texts without numbers or units."""
    out = set()
    for d, text in docs:
        words = plain_tokens(text)
        at = {}
        for p in range(len(words) - window + 1):
            at.setdefault(tuple(words[p:p + window]), []).append(p)
        for i, item in items:
            own = plain_tokens(item)
            first = {}
            for q in range(len(own) - window + 1):
                first.setdefault(tuple(own[q:q + window]), q)
            need = -(-4 * len(first) // 5)
            shifts = {}
            for w, q in first.items():
                for p in at.get(w, ()):
                    shifts.setdefault(p - q, set()).add(q)
            if need and any(len({q for t in shifts if s <= t <= s + 2 * window for q in shifts[t]}) >= need for s in shifts):
                out.add((d, i))
    return out


def found(docs, bench, **opts):
    return {(r["doc_id"], r["item_id"]) for r in rows(decontam.matches(docs, bench, **opts))}


def test_whole_table_matches_plain_windows(spark):
    from astroframe.llm.queries import QUERIES

    sf = "/root/testdata/sf0.01"
    docs = [(r["doc_id"], r["text"]) for r in rows(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text"))]
    items = [tuple(r) for r in rows(spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text"))]
    got = [(r["doc_id"], r["item_id"]) for r in rows(QUERIES["op8_benchmark_decontamination"](spark, sf))]
    assert len(got) == len(set(got)) and set(got) == plain_matches(docs, items) != set()


QUESTION = ("Tom has 3 red apples and buys 4 more apples at the market for 12 dollars before Tom gives half of the apples "
            "to Anna who walks 5 km to the old school near the river")


def test_reparameterised_questions_and_consistency(spark, make_docs):
    bench = spark.createDataFrame([(1, QUESTION)], ITEMS)
    swap = lambda **m: re.sub("|".join(m), lambda x: m[x[0]], QUESTION)
    docs = {
        1: QUESTION, 2: "Intro words here. " + QUESTION.upper() + " And more.", 3: swap(Tom="Kevin", Anna="Maria"),
        4: QUESTION.replace("3 red", "17 red").replace("buys 4", "buys 9").replace("12 dollars", "30 euros").replace("5 km", "8 miles"),
        5: QUESTION.replace("Tom has", "Kevin has").replace("Tom gives", "Peter gives"),  # one name became two
        6: "Kevin reads about Maria and the river near some old school where nobody buys apples at any market at all today",
        7: QUESTION.replace("red apples", "red and ripe apples"),  # two words put in
        8: " ".join(QUESTION.split()[:12]),
    }
    got = {d for d, _ in found(make_docs(list(docs.items())), bench)}
    assert {1, 2, 3, 4, 7} <= got and not got & {6, 8}
    hits = [(0, 0, ["tom"], ["kevin"]), (9, 9, ["tom"], ["peter"]), (12, 12, ["tom"], ["kevin"]), (13, 13, [], [])]
    assert decontam.covered(hits, 3, 10) == 3 and decontam.covered(hits, 4, 10) == 0
    both = [(0, 0, ["tom"], ["kevin"]), (1, 1, ["anna"], ["kevin"]), (2, 2, [], [])]  # two names became one
    assert decontam.covered(both, 3, 10) == 0 and decontam.covered(both, 2, 10) == 2


def test_same_shape_but_other_words_is_clean(spark, make_docs):
    bench = spark.createDataFrame([(1, "Tom has 3 apples"), (2, "In 1912 there were 40 ships of 9000 tons and 12 knots")], ITEMS)
    docs = make_docs([(1, "Lisa has 9 pears"), (2, "Then 1 2 3 4 5 6 7 8 9 10 11 12 13"), (3, "x " * 500), (4, "Max has 12 apples today")])
    assert found(docs, bench) == {(4, 1)}


def test_tokens():
    kinds = {w: decontam.token(w)[1:3] for w in ("12", "3.5km", "$4", "seven", "km", "Paris,", "the", "--", "'Yes'")}
    assert kinds["12"] == kinds["$4"] == kinds["seven"] == ("<num>", decontam.NUM)
    assert kinds["3.5km"] == ("<num><unit>", decontam.NUM) and kinds["km"] == ("<unit>", decontam.UNIT)
    assert kinds["the"] == ("the", decontam.LITERAL) and kinds["--"] == ("", decontam.LITERAL)
    assert decontam.token("Paris,")[3] and decontam.token("'Yes'")[3] and not decontam.token("the")[3] and not decontam.token("NASA")[3]


def test_passages_shared_by_many_and_repeated_in_one(spark, make_docs):
    rng = random.Random(3)
    bench = spark.createDataFrame([(i, " ".join(f"b{i}w{j}" for j in range(20))) for i in range(30)], ITEMS)
    docs = [(d, f"own{d} " * 5 + " ".join(f"b7w{j}" for j in range(20)) + f" end{d}") for d in range(200)]
    docs += [(900, (" ".join(f"b3w{j}" for j in range(20)) + " ") * 50), (901, " ".join(f"r{rng.random()}" for _ in range(3000)))]
    assert found(make_docs(docs), bench) == {(d, 7) for d in range(200)} | {(900, 3)}


def test_defined_cases(spark, make_docs):
    bench = spark.createDataFrame([(1, None), (2, ""), (3, " . "), (4, "blue moon rising"), (5, "one two"), (4, "blue moon rising"),
                                   (None, "an item without any id at all")], ITEMS)
    long = "filler words " * 60_000 + "blue moon rising"
    table = make_docs([(1, None), (2, ""), (3, "the Blue moon rising!"), (3, "the Blue moon rising!"), (None, "so blue moon rising"), (9, long),
                       (8, "this is an item without any id at all ok")])
    table = table.withColumn("form", F.lit("clash")).withColumn("k1", F.lit("clash"))
    got = found(table, bench)
    assert got == {(3, 4), (None, 4), (9, 4), (8, None)}
    clean = decontam.clean_documents(table, bench)
    assert clean.columns == table.columns and sorted(r["doc_id"] for r in rows(clean)) == [1, 2]
    nothing = spark.createDataFrame([], ITEMS)
    assert found(table, nothing) == set() == found(make_docs([]), bench)
    assert decontam.clean_documents(table, nothing).count() == 7


def test_clean_documents_of_a_questions_shape_stay(spark, make_docs):
    items = [(1, "What is the capital of France?"), (2, "Barack Obama met Angela Merkel in Berlin"),
             (3, "The Battle of Hastings in England was won by William of Normandy over King Harold Godwinson of Wessex"),
             (4, "Name the longest river in Africa.")]
    bench = spark.createDataFrame(items, ITEMS)
    docs = [(1, "Bern is the capital of Switzerland"), (2, "Emmanuel Macron met Olaf Scholz in Paris"),
            (3, "The House of Windsor in Britain was visited by Charles of Wales"), (4, "Cross the longest river in Asia."),
            (5, "Today we ask: what is the capital of France?"), (6, "We saw how Barack Obama met Angela Merkel in Berlin.")]
    assert found(make_docs(docs), bench) == {(5, 1), (6, 2)}


def test_a_name_that_opens_sentences_is_still_a_name(spark, make_docs):
    text = "Tom has 3 red apples and 4 green pears. Tom eats 2 apples and gives the rest to his best friend from school."
    bench = spark.createDataFrame([(1, text)], ITEMS)
    assert found(make_docs([(1, text.replace("Tom", "Kevin"))]), bench) == {(1, 1)}


def test_variants_whose_numbers_coincide(spark, make_docs):
    text = ("Tom has {} red apples and buys {} more apples at the market then shares them all equally with his {} friends "
            "after school today")
    bench = spark.createDataFrame([(1, text.format(3, 4, 2)), (2, "Now " + text.format(2, 5, 2).replace("Tom", "Eve"))], ITEMS)
    docs = [(1, text.format(6, 5, 5)), (2, "Now " + text.format(7, 8, 9).replace("Tom", "Eve")), (3, text.format(4, 4, 4))]
    assert {(1, 1), (2, 2), (3, 1)} <= found(make_docs(docs), bench)
    numbers = lambda *v: [(i, i, ["2"], [x], [i], [decontam.NUM], 1) for i, x in enumerate(v)]
    assert decontam.covered(numbers("7", "8", "7"), 3, 10) == 3
    assert decontam.covered([*numbers("7", "8"), (5, 1, ["2"], ["9"], [1], [decontam.NUM], 1)], 2, 10) == 2


def test_questions_of_numbers_and_units(spark, make_docs):
    items = [(1, "Convert 5 km to miles"), (2, "How many cm are in 3 m"), (3, "Calculate 12 + 7 - 3"), (4, "Add 4 lb and 3 oz, in all 2 times."),
             (5, "Is a plank of 3 in by 4 in in the box?"), (6, "7 8 9 10 11 12")]
    bench = spark.createDataFrame(items, ITEMS)
    docs = [(1, "Now convert 12 km to miles please"), (2, "How many mm are in 7 km?"), (3, "So: calculate 15 + 2 - 9 now"),
            (4, "Add 9 kg and 12 g, in all 5 times."), (5, "Is a plank of 30 cm by 5 cm in the box?"), (6, "see 7 8 9 10 11 12 there"),
            (7, "Convert 12 km and miles"), (8, "They are in 3 m of snow"), (9, "1 2 3 4 5 6 7 8 9"), (10, "the box by the sea in 4 in")]
    assert found(make_docs(docs), bench) == {(i, i) for i in range(1, 7)}
    own = decontam.Templates()
    own.read(["in 3 in the box in 4", "in five In."])
    assert own.kinds.tolist() == [0, decontam.NUM, decontam.UNIT, 0, 0, 0, decontam.NUM, 0, decontam.NUM, decontam.UNIT]


def test_a_long_part_of_an_item_is_found(spark, make_docs):
    text = " ".join(f"w{j}" for j in range(60))
    bench = spark.createDataFrame([(1, text), (2, QUESTION)], ITEMS)
    part = lambda a, b: "so " + " ".join(text.split()[a:b]) + " end"
    docs = [(1, part(10, 50)), (2, part(20, 33)), (3, part(20, 32)), (4, part(0, 10) + " x y z " + part(12, 22)),
            (5, " ".join(QUESTION.replace("12 dollars", "30 euros").split()[4:20])), (6, "1 2 3 4 5 6 7 8 9 10 11 12 13 14")]
    assert found(make_docs(docs), bench) == {(1, 1), (2, 1), (5, 2)}
