"""Language id: held-out accuracy, what it learns from, backoff order, defined cases."""

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from astroframe.llm import langid
from tests.llm.conftest import rows


def test_held_out_accuracy_of_the_whole_table(spark):
    from astroframe.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    truth = {r["doc_id"]: (r["lang"], r["text"]) for r in rows(spark.read.parquet(f"{sf}/documents.parquet"))}
    got = rows(QUERIES["op4_language_id"](spark, sf))
    assert {r["doc_id"]: r["held_out"] for r in got} == {d: zlib.crc32(str(d).encode()) % 3 == 1 for d in truth}
    judged = [r for r in got if r["held_out"] and truth[r["doc_id"]][0]]
    right = sum(r["lang_pred"] == truth[r["doc_id"]][0] for r in judged)
    assert right >= 0.95 * len(judged) and all(0 <= r["score"] <= 1 for r in got)


def test_learns_only_from_learnable_rows(make_docs):
    learn = [i for i in range(400) if zlib.crc32(str(i).encode()) % 3 != 1]
    out = [i for i in range(400) if zlib.crc32(str(i).encode()) % 3 == 1]
    docs = [(i, "alpha beta", "xx") for i in learn[:60]] + [(i, "gamma delta", "yy") for i in learn[60:120]]
    docs += [(i, "gamma delta", "zz") for i in out[:60]] + [(None, "gamma", "nn"), (learn[130], "gamma", None)]
    model = langid.train(make_docs(docs))
    assert model.langs == ["xx", "yy"]
    assert model.predict("Gamma DELTA")[0] == "yy" and model.predict("beta")[0] == "xx"


def test_known_words_win_over_grams_and_grams_back_off():
    score = lambda *v: np.array(v, np.float32)
    grams = [{"n": 2, "rows": {"ab": score(0, -1), "^z": score(-3, -1)}}, {"n": 1, "rows": {"q": score(-1, 0), "b": score(0, -9)}}]
    model = langid.Model(["a", "b"], {"abab": score(-5, 0)}, grams)
    assert model.word("abab").tolist() == [-5, 0]      # known word, though its n-grams say otherwise
    assert model.word("abx").tolist() == [0, -1]       # longest known n-grams
    assert model.word("zab").tolist() == [-1.5, -1]    # their mean
    assert model.word("qx").tolist() == [-1, 0]        # one step shorter
    assert model.word("xyz").tolist() == [0, 0]        # nothing known says nothing
    assert model.predict("xyz") == ("a", 0.5)          # ties: the smallest code


def test_training_is_bounded_per_language(make_docs):
    docs = [(i, f"word{i}", "en") for i in range(3000)]
    table = make_docs(docs)
    used = rows(langid.word_counts(table, "text", "lang", "doc_id", 200))
    assert 100 < sum(r["n"] for r in used) < 320
    # nothing of the sample is left out
    assert set(langid.train(table, per_lang=200).words) == {r["word"] for r in used}


def test_defined_cases(make_docs):
    docs = [(i, "the cat and the dog", "en") for i in range(40)] + [(100 + i, "le chat et le chien", "fr") for i in range(40)]
    model = langid.train(make_docs(docs))
    odd = [(1, None), (2, ""), (3, "123 !? _"), (None, "the dog"), (4, "le chien " * 100_000), (5, "日本"), (5, "日本")]
    table = make_docs(odd).withColumn("lang_pred", F.lit("clash")).withColumn("score", F.lit("clash")).withColumn("found", F.lit("kept"))
    named = rows(langid.identify(table, model))
    assert {r["found"] for r in named} == {"kept"}
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in named}
    assert got[1] == got[2] == got[3] == ("und", 0.0)
    assert got[None][0] == "en" and got[4][0] == "fr" and got[5][0] == "en"
    assert rows(langid.identify(make_docs([]), model)) == []
    none = langid.train(make_docs([(1, "abc", None)]))
    assert none.langs == [] and none.predict("abc") == ("und", 0.0)
    assert langid.train(make_docs([])).langs == []


def test_scores_against_plain_recomputation(make_docs):
    """Every word and n-gram counts; scores from plain dictionaries, over three languages that share words."""
    stems = {"aa": ["kora", "miv", "sul"], "bb": ["kora", "tenda", "wix"], "cc": ["miv", "wix", "obra"]}
    docs = [(100 * j + i, " ".join(f"{w}{chr(97 + i % 7)}" if i % 3 else w for w in words), lang)
            for j, (lang, words) in enumerate(stems.items()) for i in range(90)]
    model = langid.train(make_docs(docs))
    counts = {k: Counter() for k in stems}
    for i, text, lang in docs:
        if zlib.crc32(str(i).encode()) % 3 != 1:
            counts[lang].update(text.split())

    def table(n):
        out = {k: Counter() for k in stems}
        for k, c in counts.items():
            for w, m in c.items():
                marked = w if n == 0 else f"^{w}$" if n > 1 else w
                for g in [marked] if n == 0 else [marked[i:i + n] for i in range(len(marked) - n + 1)]:
                    out[k][g] += m
        keys = set().union(*out.values())
        return {g: [np.log((c[g] + 1) / (sum(c.values()) + len(keys))) for c in out.values()] for g in keys}

    tables = [table(n) for n in (0, 4, 3, 2, 1)]
    assert [set(model.words), *(set(t["rows"]) for t in model.grams)] == [set(t) for t in tables]

    def score(w):
        for n, t in zip((0, 4, 3, 2, 1), tables):
            marked = f"^{w}$" if n > 1 else w
            found = [t[g] for g in ([w] if n == 0 else [marked[i:i + n] for i in range(len(marked) - n + 1)]) if g in t]
            if found:
                return np.mean(found, axis=0)
        return np.zeros(3)

    for text in ("kora miv", "korax tend wi", "zzz obr", "sul sul wixa", "qñ"):
        total = sum(score(w) for w in text.split())
        share = np.exp((total - total.max()) / len(text.split()))
        lang, got = model.predict(text)
        assert lang == model.langs[int(total.argmax())] and np.isclose(got, share.max() / share.sum(), atol=1e-5)


def test_numerics_are_no_letters():
    model = langid.Model(["a", "b"], {"x": np.array([-5, 0], np.float32)}, [])
    assert model.predict("\u00b2 \u00bd \u2167") == ("und", 0.0)
    assert langid.letter_runs("x\u00b2y a1b_c \u65e5\u672c") == ["x", "y", "a", "b", "c", "\u65e5\u672c"]


def counted_model(counts, top=4):
    """A model of {language: Counter of words}, its n-grams counted here."""
    langs = sorted(counts)

    def table(n, key):
        found = [(k, g, m) for k, c in counts.items() for w, m in c.items()
                 for x in [w if n < 2 else f"^{w}$"] for g in ([w] if n == 0 else [x[i:i + n] for i in range(len(x) - n + 1)])]
        sums = Counter()
        for k, g, m in found:
            sums[k, g] += m
        return langid.LogFrequencies(pa.table({"lang": [k for k, _ in sums], key: [g for _, g in sums], "n": pa.array(sums.values(), pa.int64())}), key, langs)

    return langid.Model(langs, table(0, "word"), [{"n": n, "rows": table(n, "gram")} for n in range(top, 0, -1)])


TEXTS = ["kora miv SULZ", "korax tendq wi\u00b2 zzz", None, "", "12 !", "\u0130stanbul \u0391\u03a3 \u65e5\u672c tenda", "x" * 50 + " sul", "$^ kor^a $ten", "\U00020000x q1w2e_r",
         "kora " * 700 + "tend"]


def test_texts_at_once_are_scored_as_word_by_word(monkeypatch):
    counts = {"aa": Counter(kora=5, miv=2, sul=1, ας=1), "bb": Counter(kora=1, tenda=4, wix=2), "cc": Counter(miv=3, wix=2, obra=7)}
    model = counted_model(counts)
    plain = langid.Model(model.langs, dict(model.words.items()), [{"n": t["n"], "rows": dict(t["rows"].items())} for t in model.grams])
    want = [plain.predict(t) for t in TEXTS]
    for chunk in (langid.CHUNK, 100, 1):
        monkeypatch.setattr(langid, "CHUNK", chunk)
        got = model.predict_all(TEXTS)
        assert [g[0] for g in got] == [w[0] for w in want] and np.allclose([g[1] for g in got], [w[1] for w in want], atol=1e-6)
    words, text = langid.word_array([t or "" for t in TEXTS])
    assert list(zip(text.tolist(), words.to_pylist())) == [(i, w) for i, t in enumerate(TEXTS) for w in langid.letter_runs(t or "")]
    # n-grams too long for one number each go word by word
    model.grams[0]["rows"].numbers = None
    assert np.allclose([g[1] for g in model.predict_all(TEXTS)], [w[1] for w in want], atol=1e-6)


def test_a_word_of_many_texts_is_backed_off_once(monkeypatch):
    model = counted_model({"aa": Counter(kora=5, miv=2), "bb": Counter(tenda=4)})
    scored = []
    real = langid.Model.word_scores
    monkeypatch.setattr(langid.Model, "word_scores", lambda self, words: scored.extend(words.to_pylist()) or real(self, words))
    model.predict_all(["kora unseen miv"] * 500)
    assert sorted(scored) == ["kora", "miv", "unseen"]
