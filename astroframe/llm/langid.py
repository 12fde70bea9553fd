"""Language identification by word-first backoff.

Method: a known word scores its log frequency in each language; an unseen word falls back to its
character n-grams, longest first: the longest length at which the word has known n-grams scores
their mean log frequency.  A text's score is the sum over its words; the best language wins,
and its softmax share over the mean word score is reported.

The model is counted in Spark over a seeded sample of at most about ``per_lang`` labelled rows of
each language (the documented bound of the fit) and keeps every word and n-gram of that sample, with
an entry for each language that has it; predictions read every row and whole texts.

Defined cases: a null text or one without a letter is ``und`` with score 0; so is every text if no
labelled row can be learned from; rows with null language or null id are predicted and never
learned from; ties go to the smallest language code; repeated rows count and are predicted each; a very
long text is read whole, in parts; columns ``lang_pred`` and ``score`` of the input are replaced, others
pass through; an empty table gives an empty result.

A task scores the different words of some megabytes of texts at once, in arrays: a word that many texts share is looked
up, and an unseen one backed off, once for all of them.
"""

from __future__ import annotations

import re
import sys
from collections import Counter
from collections.abc import Iterator, Mapping
from functools import cached_property, lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from astroframe.functions.columns import fresh_name
from astroframe.llm.common import stored

PER_LANG = 4000
MAX_N = 4
UNKNOWN = "und"
#: a word is a run of letters; n-grams of two letters and more see a mark at both ends
LETTERS = re.compile(r"[^\W\d_]+")
NO_LETTER = re.compile(r"[\W\d_]")
#: numbers that the cache of word scores of a model of plain mappings holds (one per word and language)
CACHE = 800_000
#: characters of texts whose different words are scored at once
CHUNK = 1 << 21


def letter_runs(text: str) -> list[str]:
    """Runs of \\p{L}: the pattern also takes numerics that are no decimal digits, such as a superscript two."""
    found = LETTERS.findall(text)
    return [w for x in found for w in ([x] if x.isalpha() else "".join(c if c.isalpha() else " " for c in x).split())]


def held_out(doc_id: Column) -> Column:
    """crc32(doc_id as text) mod 3 is 1; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def letter_words(col: Column) -> Column:
    return F.array_remove(F.split(F.lower(col), r"[^\p{L}]+"), "")


def word_counts(docs: DataFrame, text: str, lang: str, doc_id: str, per_lang: int) -> DataFrame:
    """(lang, word, n) over a hash sample of at most about ``per_lang`` learnable rows per language."""
    learn = docs.where(F.col(lang).isNotNull() & F.col(doc_id).isNotNull() & ~held_out(F.col(doc_id)))
    sizes = stored(learn.groupBy(F.col(lang).alias("lang")).agg(F.count("*").alias("rows")), "lang_sizes")
    share = learn.select(F.col(lang).alias("lang"), F.col(text).alias("text"),
                         F.pmod(F.xxhash64(F.lit("fit"), doc_id), F.lit(1_000_000)).alias("h")).join(sizes, "lang")
    sample = share.where(F.col("h") * F.col("rows") < F.lit(1_000_000 * per_lang))
    found = sample.select("lang", F.explode(letter_words(F.coalesce("text", F.lit("")))).alias("word"))
    return found.groupBy("lang", "word").agg(F.count("*").alias("n"))


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def numbered(digits: np.ndarray, n: int, base: int) -> np.ndarray:
    """Each run of ``n`` digits, read as a number."""
    out = np.zeros(max(0, len(digits) - n + 1), dtype=np.int64)
    for i in range(n):
        out = out * base + digits[i:i + len(out)]
    return out


@lru_cache(maxsize=1)
def is_letter() -> np.ndarray:
    """For each code point, whether it is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(sys.maxunicode + 1)), dtype=bool, count=sys.maxunicode + 1)


def parts(text: str, size: int) -> Iterator[str]:
    """The text in parts of about ``size`` characters, none of which cuts a run of letters."""
    at = 0
    while len(text) - at > size and (cut := NO_LETTER.search(text, at + size)):
        yield text[at:cut.start()]
        at = cut.start()
    yield text[at:]


def word_array(texts: list[str]) -> tuple[pa.StringArray, np.ndarray]:
    """``letter_runs`` of all texts in one array, and the number of each one's text."""
    points = code_points("\n".join(texts))
    letter = is_letter()[points]
    edge = np.flatnonzero(np.diff(letter, prepend=False, append=False))
    first, last = edge[::2], edge[1::2]
    kept = points[letter]
    size = 1 + (kept >= 0x80).astype(np.int32) + (kept >= 0x800) + (kept >= 0x10000)
    place = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
    offsets = place[np.concatenate([[0], np.cumsum(last - first)])]
    data = kept.tobytes().decode("utf-32-le").encode()
    words = pa.StringArray.from_buffers(len(first), pa.py_buffer(offsets), pa.py_buffer(data))
    return words, np.searchsorted(np.cumsum([len(t) + 1 for t in texts]), first, side="right")


class LogFrequencies(Mapping):
    """key -> add-one log frequency per language, of counted (lang, key, n) rows.

    A language that lacks a key gives it log(1 / (total + keys)); one that has it n times adds log(n + 1).  Only the
    latter is kept for a key, so the size follows the counted rows, not keys x languages.
    """

    def __init__(self, counted: pa.Table, key: str, langs: list[str]):
        n = counted["n"].to_numpy().astype(np.float64)
        named, coded = (counted[c].combine_chunks().dictionary_encode() for c in ("lang", key))
        at = {x: i for i, x in enumerate(langs)}
        lang = np.array([at[x] for x in named.dictionary.to_pylist()], dtype=np.int32)[named.indices.to_numpy()]
        codes, self.keys = coded.indices.to_numpy(), coded.dictionary
        order = np.argsort(codes, kind="stable")
        self.start = np.concatenate([[0], np.cumsum(np.bincount(codes, minlength=len(self.keys)))]).astype(np.int64)
        self.lang, self.add = lang[order], np.log(n[order] + 1).astype(np.float32)
        totals = np.bincount(lang, weights=n, minlength=len(langs))
        self.least = -np.log(totals + max(1, len(self.keys))).astype(np.float32)

    @cached_property
    def row(self) -> dict[str, int]:
        """Place of each key; built where it is first used, so the driver gathers and sends Arrow strings alone."""
        return dict(zip(self.keys.to_pylist(), range(len(self.keys))))

    def __getitem__(self, key: str) -> np.ndarray:
        row = self.row[key]
        at = slice(self.start[row], self.start[row + 1])
        out = self.least.copy()
        out[self.lang[at]] += self.add[at]
        return out

    def dense(self, rows: np.ndarray, kind: type = np.float32) -> np.ndarray:
        """The scores of the keys at these places, one line per key."""
        out = np.tile(self.least.astype(kind), (len(rows), 1))
        size = self.start[rows + 1] - self.start[rows]
        ends = np.cumsum(size)
        at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.start[rows] - (ends - size), size)
        out[np.repeat(np.arange(len(rows)), size), self.lang[at]] += self.add[at]
        return out

    def places(self, keys: pa.StringArray) -> np.ndarray:
        """Place of each key, -1 if it has none."""
        return pc.index_in(keys, value_set=self.keys).fill_null(-1).to_numpy(zero_copy_only=False)

    @cached_property
    def numbers(self) -> tuple[np.ndarray, pa.Array] | None:
        """For keys of one length in characters: the characters in use, and each key as one number with a digit per
        character (from 1); None if 63 bits do not hold it."""
        if not len(self.keys):
            return np.empty(0, np.uint32), pa.array([], pa.int64())
        points = code_points("".join(self.keys.to_pylist())).reshape(len(self.keys), -1)
        used = np.unique(points)
        if (len(used) + 1) ** points.shape[1] >= 1 << 63:
            return None
        return used, pa.array(numbered(np.searchsorted(used, points.ravel()) + 1, points.shape[1], len(used) + 1)[::points.shape[1]])

    def __contains__(self, key: object) -> bool:
        return key in self.row

    def __iter__(self) -> Iterator[str]:
        return iter(self.row)

    def __len__(self) -> int:
        return len(self.keys)


class Model:
    """Log frequencies of words and n-grams (each a mapping to one float32 per language)."""

    def __init__(self, langs: list[str], words: Mapping[str, np.ndarray], grams: list[dict]):
        self.langs, self.words, self.grams = langs, words, grams
        self.cache: dict[str, np.ndarray] = {}

    def word(self, w: str) -> np.ndarray:
        """Scores of a lower-case word, by backoff."""
        got = self.cache.get(w)
        if got is None:
            got = self.backed_off(w)
            if len(self.cache) * len(self.langs) >= CACHE:
                self.cache.clear()
            self.cache[w] = got
        return got

    def backed_off(self, w: str) -> np.ndarray:
        if w in self.words:
            return self.words[w]
        for table in self.grams:
            n = table["n"]
            marked = f"^{w}$" if n > 1 else w
            found = [table["rows"][g] for i in range(len(marked) - n + 1) if (g := marked[i:i + n]) in table["rows"]]
            if found:
                return np.mean(found, axis=0, dtype=np.float32)
        return np.zeros(len(self.langs), np.float32)

    def word_scores(self, words: pa.StringArray) -> np.ndarray:
        """Scores of many different words at once, a line each; the same backoff as for one."""
        places = self.words.places(words)
        out = np.zeros((len(words), len(self.langs)))
        known, left = np.flatnonzero(places >= 0), np.flatnonzero(places < 0)
        out[known] = self.words.dense(places[known], np.float64)
        for table in self.grams:
            if not len(left):
                break
            n, rows = table["n"], table["rows"]
            if rows.numbers is None:
                out[left] = [self.backed_off(w) for w in words.take(pa.array(left)).to_pylist()]
                break
            used, keys = rows.numbers
            points = code_points(f"^{'$^'.join(words.take(pa.array(left)).to_pylist())}$")
            word = np.cumsum(points == ord("^")) - 1
            if n == 1:  # without the marks
                inner = (points != ord("^")) & (points != ord("$"))
                points, word = points[inner], word[inner]
            digits = np.searchsorted(used, points)
            digits = np.where(np.append(used, 0)[digits] == points, digits + 1, 0)
            spots = numbered(digits, n, len(used) + 1)
            at = pc.index_in(pa.array(spots), value_set=keys).fill_null(-1).to_numpy(zero_copy_only=False)
            hit = np.flatnonzero((at >= 0) & (word[:len(spots)] == word[n - 1:]))
            grams, gram = np.unique(at[hit], return_inverse=True)
            owner, value = word[hit], rows.dense(grams)
            count = np.bincount(owner, minlength=len(left))
            total = np.zeros((len(self.langs), len(left)), np.float32)
            for i, line in enumerate(total):
                np.add.at(line, owner, value[gram, i])
            found = count > 0
            out[left[found]] = (total[:, found] / count[found].astype(np.float32)).T
            left = left[~found]
        return out

    def predict(self, text: str | None) -> tuple[str, float]:
        if isinstance(self.words, LogFrequencies):
            return self.predict_all([text])[0]
        counts = Counter(letter_runs((text or "").lower()))
        n = np.fromiter(counts.values(), dtype=np.float64, count=len(counts))
        total = n @ np.array([self.word(w) for w in counts], dtype=np.float64).reshape(len(counts), len(self.langs))
        return self.verdicts(total[None], n.sum(keepdims=True))[0]

    def predict_all(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """The texts' languages and scores; about ``CHUNK`` characters at a time have their different words scored once."""
        if not self.langs:
            return [(UNKNOWN, 0.0)] * len(texts)
        total, n = np.zeros((len(texts), len(self.langs))), np.zeros(len(texts))
        held: list[tuple[int, str]] = []
        size = 0
        for i, text in enumerate(texts):
            for part in parts((text or "").lower(), CHUNK):
                if held and size + len(part) > CHUNK:
                    self.count_in(held, total, n)
                    held, size = [], 0
                held.append((i, part))
                size += len(part)
        if held:
            self.count_in(held, total, n)
        return self.verdicts(total, n)

    def count_in(self, held: list[tuple[int, str]], total: np.ndarray, n: np.ndarray) -> None:
        """Adds the words of parts of texts to their texts' sums."""
        words, part = word_array([t for _, t in held])
        coded = words.dictionary_encode()
        code, text = coded.indices.to_numpy(), np.array([i for i, _ in held])[part]
        n += np.bincount(text, minlength=len(n))
        for i, line in enumerate(self.word_scores(coded.dictionary).T):
            total[:, i] += np.bincount(text, weights=line[code], minlength=len(n))

    def verdicts(self, total: np.ndarray, n: np.ndarray) -> list[tuple[str, float]]:
        if not self.langs:
            return [(UNKNOWN, 0.0)] * len(n)
        share = np.exp((total - total.max(axis=1, keepdims=True)) / np.maximum(1.0, n)[:, None])
        best = total.argmax(axis=1)
        score = share[np.arange(len(n)), best] / share.sum(axis=1)
        return [(self.langs[b], s) if m else (UNKNOWN, 0.0) for b, s, m in zip(best.tolist(), score.tolist(), n.tolist())]


def train(docs: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id", per_lang: int = PER_LANG,
          max_n: int = MAX_N) -> Model:
    """Counts words and n-grams of the sample in Spark; the driver gathers the counts, whose number the sample bounds."""
    counts = stored(word_counts(docs, text, lang, doc_id, per_lang), "lang_words")
    langs = sorted(r["lang"] for r in counts.select("lang").distinct().collect())
    words = LogFrequencies(counts.toArrow(), "word", langs)
    tables = []
    for n in range(max_n, 0, -1):
        marked = F.concat(F.lit("^"), F.col("word"), F.lit("$")) if n > 1 else F.col("word")
        spots = F.when(F.length(marked) >= n, F.sequence(F.lit(1), F.length(marked) - (n - 1))).otherwise(F.array().cast("array<int>"))
        grams = counts.select("lang", "n", F.explode(F.transform(spots, lambda i: F.substring(marked, i, F.lit(n)))).alias("gram"))
        grams = grams.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
        tables.append({"n": n, "rows": LogFrequencies(grams.toArrow(), "gram", langs)})
    return Model(langs, words, tables)


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Adds ``lang_pred`` and ``score``; the model (bounded by the sample it was counted over) is broadcast."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = shared.value
        for texts in batches:
            yield pd.DataFrame(own.predict_all(texts.tolist()), columns=["lang_pred", "score"]).astype(
                {"lang_pred": "object", "score": "float64"})

    found = fresh_name(docs, "found")
    out = docs.withColumn(found, predict(F.col(text)))
    return out.withColumns({"lang_pred": F.col(f"{found}.lang_pred"), "score": F.col(f"{found}.score")}).drop(found)
