"""Benchmark decontamination by template canonicalisation.

Method: words become template tokens: numbers, units and names turn into typed placeholders, the
rest is lower-cased without its outer punctuation.  Windows of template tokens of the benchmark
are hash-joined with those of the documents.  A document is contaminated by an item when the
windows that line up cover enough of the item *and* the placeholders are filled consistently:
each number or unit has one value at its place, whatever other places hold, and each name of the item
stands for one name of the document throughout (so a re-parameterised question is caught, while
unrelated text of the same shape is not).

Two forms are matched: ``plain`` keeps names as words (so a copy in other letter case is found)
and ``named`` turns capitalised words into placeholders.  Cover counts all windows of the item in
either form.  A window with fewer than ``MIN_LITERALS`` literal words says nothing alone: it matches as
a template together with the nearest literal words around it, and in the plain form also with its values.
An item with fewer literal words, but one, matches if its whole template agrees.

A document that holds ``STRETCH`` tokens of an item in a row is a match too, whatever the item's length.

Besides its windows a match needs proof: literal words (or equal values) at places of the item, 0.8 of its
literal words and, up to six, half of its literal words and names.  A capital that opens a sentence is
no name by itself: function words never are, and other openers only if the item has them as names
elsewhere, or if the whole item agrees.

Defined cases: null, empty or blank texts and items match nothing; an item shorter than the
window is one window of its own length; equal rows get equal verdicts; a null doc_id or item_id
is carried through; empty tables on either side give no matches.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from astroframe.llm.common import bitmap, content_key, in_bitmap, stored

WINDOW = 5
MIN_COVER = 0.8
#: so many tokens of an item in a row are a match whatever the rest of the item
STRETCH = 13
#: a window of template tokens must have this many literal words, or is widened to have them
MIN_LITERALS = 3
#: names may outnumber literal words when this many places of the item are proven
MIN_PROOF = 6
#: fixed values: units of measure and currency that become a placeholder
UNITS = frozenset("""mm cm m km in ft yd mi inch inches foot feet yard yards mile miles meter meters metre metres kilometer
kilometers kilometre kilometres mg g kg lb lbs oz gram grams kilogram kilograms pound pounds ounce ounces ton tons ml l liter
liters litre litres gallon gallons ms s sec second seconds min minute minutes h hr hour hours day days week weeks month months
year years dollar dollars euro euros cent cents percent usd eur mph kmh degrees""".split())
#: a unit only after a number
INCHES = "in"
NUMBER_WORDS = frozenset("""zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen
seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion""".split())
#: fixed values: words that are no names when a sentence opens with them
COMMON = frozenset("""a about above according after all also although among an and another any are as assume at be because been
before being below between both but by calculate can choose complete compute consider convert could define describe determine did
do does during each either estimate evaluate every explain express factor few fill find for from give given had has have he hence
her here his how however i identify if in into is it its let list many may might more most much must my name neither no not now of
on once one only or other our over select she should show simplify since so solve some state such suppose than that the their them
then there therefore these they this those though through thus to true under until up use using was we were what when where whether
which while who whom whose why will with without would write you your""".split())
NUMBER = re.compile(r"[+-]?[$€£]?\d[\d.,:/]*(.*)", re.S)

LITERAL, NUM, UNIT, NAME, OPENER = 0, 1, 2, 3, 4
NAME_HASH = xxhash.xxh64_intdigest("<name>")
UNIT_HASH = xxhash.xxh64_intdigest("<unit>")
BASE = 0x9E3779B97F4A7C15
FLUSH_TOKENS = 200_000
CACHE = 300_000


PUNCTUATION = "!\"#%&'()*+,./:;<=>?@[\\]^_`{|}~-“”‘’«»¿¡…–—"


def token(word: str) -> tuple[str, str, int, bool]:
    """(raw, plain, kind, capitalised) of a word; raw is '' for pure punctuation."""
    core = word.strip(PUNCTUATION)
    raw = core.lower()
    if raw in NUMBER_WORDS:
        return raw, "<num>", NUM, False
    if raw in UNITS and raw != INCHES:
        return raw, "<unit>", UNIT, False
    letters = raw.isalpha()
    if not letters:
        if not raw:
            return "", "", LITERAL, False
        number = NUMBER.fullmatch(raw)
        if number:
            tail = number[1].strip("%°")
            return raw, "<num><unit>" if tail in UNITS else "<num>", NUM, False
    if core[0] == raw[0] or not core[0].isupper() or raw in COMMON:
        return raw, raw, LITERAL, False
    return raw, raw, LITERAL, len(core) == 1 or core[1:] != core[1:].upper() or not core[1:].isalpha()


class Forms(dict):
    """word -> number of its form; a new word is learnt when it is first asked for."""

    def __init__(self, learn):
        super().__init__()
        self.learn = learn

    def __missing__(self, word: str) -> int:
        self[word] = number = self.learn(word)
        return number


def powers(n: int, cache: dict = {}) -> tuple[np.ndarray, np.ndarray]:  # noqa: B006 - kept between calls
    """B**i and B**-i modulo 2**64 for i below n (at least)."""
    if cache.get("n", 0) < n:
        cache["n"] = size = max(n, FLUSH_TOKENS * 2)
        for name, base in (("up", BASE), ("down", pow(BASE, -1, 1 << 64))):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            cache[name] = np.multiply.accumulate(steps)
    return cache["up"], cache["down"]


class Form:
    """Texts in one form: hashes of any range of tokens, and windows widened to enough literal words."""

    def __init__(self, tokens: np.ndarray, literal: np.ndarray, doc: np.ndarray, seed: int):
        up, self.down = powers(len(tokens) + 1)
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(tokens * up[:len(tokens)], dtype=np.uint64)])
        self.before = np.concatenate([[0], np.cumsum(literal)])
        self.at, self.doc, self.seed = np.nonzero(literal)[0], doc, seed

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        h = (self.sums[end] - self.sums[start]) * self.down[start] + np.uint64(self.seed) + (end - start).astype(np.uint64) * np.uint64(16)
        for shift in (32, 29):
            h = (h ^ (h >> np.uint64(shift))) * np.uint64(0xD6E8FEB86659FD93)
        return h ^ (h >> np.uint64(32))

    def literals(self, start: np.ndarray, n: int) -> np.ndarray:
        return self.before[start + n] - self.before[start]

    def widened(self, start: np.ndarray, n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(window, hash) of the windows with each choice of the nearest literal words on their left and
        right that makes up ``MIN_LITERALS``, within the text; a window with enough is hashed as it is."""
        lack = MIN_LITERALS - np.minimum(MIN_LITERALS, self.literals(start, n))
        last = len(self.at) - 1
        for left in range(MIN_LITERALS + 1):
            p = start[lack >= left] if left else start
            right = (lack[lack >= left] if left else lack) - left
            if not left:
                whole = p[right == 0]
                yield whole, self.hash(whole, whole + n)
                p, right = p[right > 0], right[right > 0]
            low, high = self.before[p] - left, self.before[p + n] + right - 1
            ok = (low >= 0) & ((high <= last) | (right == 0))
            p, low, high, right = p[ok], low[ok], high[ok], right[ok]
            if not len(p):
                continue
            first = self.at[low] if left else p
            end = np.where(right > 0, self.at[np.minimum(high, last)] + 1, p + n)
            ok = (self.doc[first] == self.doc[p]) & (self.doc[end - 1] == self.doc[p])
            yield p[ok], self.hash(first[ok], end[ok])


class Templates:
    """Window hashes of many texts at once; word forms are cached, bounded by ``CACHE`` words."""

    def __init__(self, window: int = WINDOW):
        self.window = window
        self._clear()

    def _clear(self) -> None:
        self.at = Forms(self._learn)
        self.raw, self.plain, self.named, self.kind, self.cap = [0], [0], [0], [0], [False]
        self.inch = [False]
        self.words = [""]

    def _learn(self, word: str) -> int:
        raw, plain, kind, cap = token(word)
        if not raw:
            return 0
        h = xxhash.xxh64_intdigest(raw)
        p = h if plain == raw else xxhash.xxh64_intdigest(plain)
        self.raw.append(h)
        self.plain.append(p)
        self.named.append(NAME_HASH if cap else p)
        self.kind.append(kind)
        self.cap.append(cap)
        self.inch.append(raw == INCHES)
        self.words.append(raw)
        return len(self.words) - 1

    def read(self, texts: list[str | None]) -> None:
        """Tokens of the texts: ``ids``, ``doc``, ``offsets`` and the forms raw, plain and named."""
        if len(self.at) > CACHE:
            self._clear()
        number = self.at.__getitem__
        ids, sizes = [], []
        for text in texts:
            before = len(ids)
            ids.extend(map(number, (text or "").split()))
            sizes.append(len(ids) - before)
        idx = np.fromiter(ids, dtype=np.int64, count=len(ids))
        real = idx != 0
        self.doc = doc = np.repeat(np.arange(len(texts)), sizes)[real]
        self.ids = idx = idx[real]
        self.offsets = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=len(texts)), dtype=np.int64)])
        raw, plain, named = (np.asarray(x, dtype=np.uint64)[idx] for x in (self.raw, self.plain, self.named))
        self.kinds = np.asarray(self.kind, dtype=np.int8)[idx]
        inch = np.nonzero(np.asarray(self.inch, dtype=bool)[idx[1:]] & (self.kinds[:-1] == NUM) & (doc[1:] == doc[:-1]))[0] + 1
        self.kinds[inch] = UNIT
        plain[inch] = named[inch] = UNIT_HASH
        slot = self.kinds != LITERAL
        self.caps = cap = np.asarray(self.cap, dtype=bool)[idx]
        self.forms = {"raw": Form(raw, ~slot, doc, 1), "plain": Form(plain, ~slot, doc, 2), "named": Form(named, ~(slot | cap), doc, 3)}

    def starts(self, n: int) -> np.ndarray:
        """Where windows of n tokens begin."""
        count = len(self.ids) - n + 1
        return np.nonzero(self.doc[:count] == self.doc[n - 1:])[0] if count > 0 else np.empty(0, np.int64)

    def windows(self, form: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(start, hash) of the windows in a form: widened to enough literal words, in the plain form also with their values."""
        n, start = self.window, self.starts(self.window)
        yield from self.forms[form].widened(start, n)
        if form == "plain":
            few = start[self.forms["plain"].literals(start, n) < MIN_LITERALS]
            yield few, self.forms["raw"].hash(few, few + n)

    def whole(self, form: str, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(start, hash) of the windows that may be a whole item of n tokens, one that is shorter than a window
        or has few literal words: as a template if there is a literal word, a short one else with its values."""
        start = self.starts(n)
        literals = self.forms[form].literals(start, n)
        if n >= self.window:
            start = start[(literals > 0) & (literals < MIN_LITERALS)]
            return start, self.forms[form].hash(start, start + n)
        if form == "named":
            start = start[literals > 0]
            return start, self.forms["named"].hash(start, start + n)
        return start, np.where(literals > 0, self.forms["plain"].hash(start, start + n), self.forms["raw"].hash(start, start + n))

    def slots(self, start: int, n: int, form: str) -> list[int]:
        """Places of a window's placeholders."""
        marks = self.kinds[start:start + n] != LITERAL
        if form == "named":
            marks = marks | self.caps[start:start + n]
        return np.nonzero(marks)[0].tolist()

    def values(self, start: int, places: list[int]) -> list[str]:
        return [self.words[self.ids[start + i]] for i in places]


SENTENCE_END = re.compile(r"[.!?:;\u2026][\"')\]\u201d\u2019\u00bb]*$")
TITLES = frozenset("mr mrs ms dr prof st vs no".split())


def openers(text: str) -> list[bool]:
    """For each token of a text: does it open a sentence or a line?"""
    out = []
    for line in (text or "").splitlines():
        opens = True
        for word in line.split():
            raw = token(word)[0]
            if raw:
                out.append(opens)
                opens = False
            if SENTENCE_END.search(word) and raw not in TITLES and not (len(raw) == 1 and word[0].isupper()):
                opens = True
    return out


#: a hit, in the order that ``covered`` reads
HIT_FIELDS = ["pos", "ipos", "islots", "slots", "places", "kinds", "n"]
#: groups of one document and item whose hits are looked at together
GROUPS_AT_ONCE = 64
HIT_SCHEMA = "k1 long, k2 long, id long, form string, n int, pos int, wh long, slots array<string>"
ITEM_SCHEMA = ("i1 long, i2 long, item_id long, form string, n int, ipos int, wh long, islots array<string>, places array<int>, "
               "kinds array<int>, item_windows int, proof int")


def parts(batch: pa.RecordBatch) -> Iterator[list[tuple]]:
    """A batch's rows (k1, k2, id, text) in parts of about ``FLUSH_TOKENS`` tokens."""
    part, size = [], 0
    for k1, k2, ident, text in zip(*(batch.column(i) for i in range(4))):
        part.append((k1.as_py(), k2.as_py(), ident.as_py(), text.as_py()))
        size += len(part[-1][3] or "")
        if size >= FLUSH_TOKENS * 5:
            yield part
            part, size = [], 0
    if part:
        yield part


def arrow(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "array<string>": pa.list_(pa.string()),
             "array<int>": pa.list_(pa.int32())}
    fields = [f.split() for f in schema.split(", ")]
    columns = list(zip(*rows)) if rows else [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields)], names=[f for f, _ in fields])


def whole_form(form: str, n: int, window: int) -> str:
    """Items of few literal words match as a whole, beside their windows with values."""
    return f"{form} whole" if n >= window else form


def item_windows(own: Templates, key: tuple, text: str | None) -> list[tuple]:
    """The index rows of one item.  A template that comes again is used at its first place only."""
    own.read([text])
    size, out = len(own.ids), []
    if not size:
        return out
    opens = openers(text)
    words = [own.words[i] for i in own.ids]
    inner = {w for w, cap, first in zip(words, own.caps, opens) if cap and not first}
    again = {w for w in set(words) if sum(x == w for x in words) > 1 and all(own.caps[i] for i, x in enumerate(words) if x == w)}
    kinds = [k if k != LITERAL or not cap else OPENER if first and w not in inner | again else NAME
             for k, cap, first, w in zip(own.kinds.tolist(), own.caps.tolist(), opens, words)]
    for form in ("plain", "named"):
        if form == "named" and not own.caps.any():
            continue
        n, literal = own.window, own.forms[form].at
        rows, short = [], []
        if size < n or len(literal) < MIN_LITERALS:
            start, hashes = own.whole(form, size)
            short = list(zip(start.tolist(), hashes.tolist()))
        else:
            taken: dict[int, int] = {}
            for start, hashes in own.forms[form].widened(own.starts(n), n):
                for s, h in zip(start.tolist(), hashes.tolist()):
                    taken.setdefault(s, h)
            firsts: dict[int, int] = {}
            for s in sorted(taken):
                firsts.setdefault(taken[s], s)
            rows = [(s, h) for h, s in firsts.items()]
        if form == "plain" and size >= n:
            few = np.array(sorted(s for s, _ in rows) or range(size - n + 1), np.int64)
            few = few[own.forms["plain"].literals(few, n) < MIN_LITERALS]
            exact: dict[int, int] = {}
            for s, h in zip(few.tolist(), own.forms["raw"].hash(few, few + n).tolist()):
                exact.setdefault(h, s)
            rows += [(s, h) for h, s in exact.items()]
        for n, label, rows in ((n, form, rows), (size, whole_form(form, size, n), short)):
            inside = {s + i for s, _ in rows for i in range(n)}
            literals = len(inside & set(literal.tolist()))
            names = sum(kinds[i] >= NAME for i in inside) if form == "named" else 0
            proof = max(-(-4 * literals // 5), min(MIN_PROOF, -(-(literals + names) // 2)))
            for s, h in rows:
                places = own.slots(s, n, form)
                out.append((*key, label, n, s, h - (1 << 64) if h >> 63 else h, own.values(s, places), [s + i for i in places],
                            [kinds[s + i] for i in places], len({s for s, _ in rows}), proof))
    return out


def item_rows(items: DataFrame, window: int) -> DataFrame:
    """The windows of the items (columns k1, k2, id, text), with what a match of the item needs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Templates(window)
        for batch in batches:
            for part in parts(batch):
                yield arrow([row for *key, text in part for row in item_windows(own, tuple(key), text)], ITEM_SCHEMA)

    return items.select("k1", "k2", "id", "text").mapInArrow(run, ITEM_SCHEMA)


def window_rows(df: DataFrame, window: int, lengths: list[int], seen) -> DataFrame:
    """One row per window of the texts (columns k1, k2, id, text), also of the given lengths.
    ``seen``, a broadcast bitmap, drops windows whose hash is surely not among its keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Templates(window)
        bm = seen.value

        def rows(part: list[tuple]) -> Iterator[tuple]:
            own.read([t for *_, t in part])
            for form in ("plain", "named"):
                sets = [(form, window, *found) for found in own.windows(form)]
                sets += [(whole_form(form, n, window), n, *own.whole(form, n)) for n in lengths]
                for label, n, start, hashes in sets:
                    pick = in_bitmap(bm, hashes)
                    for s, h in zip(start[pick].tolist(), hashes[pick].astype(np.int64).tolist()):
                        d = int(own.doc[s])
                        yield (*part[d][:3], label, n, s - int(own.offsets[d]), h, own.values(s, own.slots(s, n, form)))

        for batch in batches:
            for part in parts(batch):
                yield arrow(list(rows(part)), HIT_SCHEMA)

    return df.select("k1", "k2", "id", "text").mapInArrow(run, HIT_SCHEMA)


def slot_keys(hit: tuple) -> list[str | int]:
    """What must keep one value along a stretch: a name by its word, a number or unit by its place in the item."""
    if len(hit) == 4:
        return hit[2]
    return [a if k >= NAME else p for a, p, k in zip(hit[2], hit[4], hit[5])]


def consistent(part: list[tuple], strict: bool = True) -> list[tuple]:
    """The hits of a stretch whose values don't contradict its usual pairing: a place of a number or unit has one value
    (places may share it), and names pair one to one.  If ``strict``, a word that only opens a sentence must stay as it is."""
    keys = [slot_keys(h) for h in part]
    votes: dict[str | int, dict[str, int]] = {}
    for own, h in zip(keys, part):
        for a, b in zip(own, h[3]):
            row = votes.setdefault(a, {})
            row[b] = row.get(b, 0) + 1
    usual = {a: max(sorted(row), key=row.get) for a, row in votes.items()}
    taken: dict[str, str] = {}
    for a in sorted((a for a in usual if isinstance(a, str)), key=lambda a: (-max(votes[a].values()), a)):
        if taken.setdefault(usual[a], a) != a:
            usual[a] = None
    return [h for own, h in zip(keys, part) if all(usual[a] == b for a, b in zip(own, h[3]))
            and not (strict and len(h) > 4 and any(k == OPENER and a != b for a, b, k in zip(h[2], h[3], h[5])))]


def proven(hits: list[tuple]) -> int:
    """Places of the item that hold a literal word, or the same value in the document."""
    out = set()
    for _, at, theirs, ours, *more in hits:
        if more:
            places, _, n = more
            out.update(set(range(at, at + n)) - {p for p, a, b in zip(places, theirs, ours) if a != b})
    return len(out)


def longest(hits: list[tuple], proof: int) -> int:
    """Most tokens of the item in a row that windows at one shift cover, with ``proof`` places proven."""
    best, run, end = 0, [], (0, 0)
    for h in sorted(hits, key=lambda h: (h[0] - h[1], h[1])):
        if run and (h[0] - h[1] != end[0] or h[1] > end[1]):
            run = []
        end = (h[0] - h[1], max(h[1] + h[6], end[1] if run else 0))
        run.append(h)
        if end[1] - run[0][1] > best and proven(run) >= proof:
            best = end[1] - run[0][1]
    return best


def covered(hits: list[tuple], need: int, reach: int, proof: int = 0, windows: int = 0, stretch: int = 0) -> int:
    """Most item windows that one stretch of the document covers with consistent slots; 0 if fewer than ``need``
    or if fewer than ``proof`` places of the item are proven, unless ``stretch`` tokens of the item are covered in a
    row at one shift, 0.8 of as many of them proven.

    ``hits`` are (document place, item place, item slots, document slots), and where names are told apart
    or proof is needed also (slot places, slot kinds, length).  A stretch holds hits whose shift (document
    minus item place) stays within ``reach`` of the stretch's first, so a few inserted or dropped words
    don't split it.  Windows whose values contradict the stretch's usual pairing don't count.  All ``windows`` of the item at one shift may differ in words that open a sentence.
    """
    ordered = sorted(hits, key=lambda h: (h[0] - h[1], h[0]))
    best, lo = 0, 0
    shifts = [h[0] - h[1] for h in ordered]
    while lo < len(ordered):
        hi = lo
        while hi < len(ordered) and shifts[hi] <= shifts[lo] + reach:
            hi += 1
        step = next((i for i in range(lo, hi) if shifts[i] > shifts[lo]), hi)
        for part, strict, enough in ((ordered[lo:hi], True, need), (ordered[lo:step], False, max(need, windows))):
            if (strict or windows) and len({h[1] for h in part}) >= enough:
                good = consistent(part, strict)
                count = len({h[1] for h in good})
                if count >= enough and proven(good) >= proof:
                    best = max(best, count)
        if stretch and not best:
            good = consistent(ordered[lo:hi])
            if longest(good, math.ceil(MIN_COVER * stretch)) >= stretch:
                best = len({h[1] for h in good})
        lo = step
    return best


def matches(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
            item_text: str = "text", window: int = WINDOW, min_cover: float = MIN_COVER, stretch: int = STRETCH) -> DataFrame:
    """Contaminated documents: one row per document key and item: k1, k2, doc_id, item_id, windows, item_windows, form.

    The documents' windows meet a bitmap of the benchmark's hashes first (at most 16 MiB, no
    false negatives), so only likely matches leave the scan; the join with the benchmark's
    windows then decides.  A window of an item is used at its first place only, and groups
    are one document by one item.
    """
    spark = docs.sparkSession
    items = benchmark.select(*content_key(item_id, item_text), F.col(item_id).cast("long").alias("id"), F.col(item_text).alias("text"))
    index = stored(item_rows(items.dropDuplicates(["k1", "k2"]), window), "item_index")
    stats = index.agg(F.count("*").alias("n"), F.collect_set(F.when((F.col("n") < window) | F.col("form").endswith("whole"), F.col("n"))).alias("lengths")).first()
    lengths = sorted(stats["lengths"])
    seen = spark.sparkContext.broadcast(bitmap(index, "wh", stats["n"]))

    rows = docs.select(*content_key(doc_id, text), F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))
    hits = window_rows(rows, window, lengths, seen)
    hits = hits.join(index, ["form", "n", "wh"])
    hits = hits.groupBy("k1", "k2", "id", "i1", "i2", "item_id", "form", "item_windows", "proof").agg(
        F.collect_set(F.struct(*HIT_FIELDS)).alias("hits"))
    need = F.ceil(F.col("item_windows") * F.lit(min_cover)).cast("int")
    least = F.least(F.col("need"), F.lit(-(-stretch // window) if stretch else 1 << 30))
    hits = hits.withColumn("need", need).where(F.size(F.array_distinct(F.transform("hits", lambda h: h["ipos"]))) >= least)

    keys = ["k1", "k2", "id", "i1", "i2", "item_id", "form", "item_windows"]
    schema = hits.select(*keys).schema.add("windows", "integer")

    def verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, GROUPS_AT_ONCE):  # only these groups' hits become Python objects
                part = batch.slice(at, GROUPS_AT_ONCE)
                counts = [covered([tuple(h.values()) for h in found], need, 2 * window, proof, windows, stretch)
                          for found, need, proof, windows in zip(*(part.column(c).to_pylist() for c in ("hits", "need", "proof", "item_windows")))]
                out = pa.RecordBatch.from_arrays([*(part.column(c) for c in keys), pa.array(counts, pa.int32())], names=[*keys, "windows"])
                yield out.filter(pc.greater(out.column("windows"), 0))

    out = hits.select(*keys, "need", "proof", "hits").mapInArrow(verified, schema)
    best = F.max(F.struct("windows", "form", "item_windows"))
    out = out.groupBy("k1", "k2", F.col("id").alias("doc_id"), "i1", "i2", "item_id").agg(best.alias("b"))
    return out.select("k1", "k2", "doc_id", "item_id", "b.windows", "b.item_windows", "b.form")


def clean_documents(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents (all columns) that no benchmark item contaminates."""
    found = stored(matches(docs, benchmark, doc_id, text).select("k1", "k2").distinct(), "contaminated")
    rows = docs.select(F.struct("*").alias("doc"), *content_key(doc_id, text))
    return rows.join(found, ["k1", "k2"], "left_anti").select("doc.*")
