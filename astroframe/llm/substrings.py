"""Exact repeated-substring removal by a prefix-free style parse of the corpus.

Every byte covered by a string of ``length`` bytes that also starts anywhere else in the corpus is
removed.  The parse follows prefix-free parsing: a rolling hash of 16 bytes picks triggers, the text
around a trigger is a phrase, the distinct phrases with their counts are the dictionary and each
document keeps its places in it.  A trigger is the (first) smallest rolling hash of some window of
``length`` bytes, so every such window has exactly one trigger, equal windows have it at the same
place, and a phrase stands for the 1 to 385 windows that share a trigger.

Instead of sorting all dictionary suffixes, phrases are compared by hashes of their common core (the
bytes that lie in all windows of a block of offsets) and of their whole span:

* a core that occurs once has no repeated window;
* a core whose occurrences all have the same span has only repeated windows;
* the rest are refined: blocks of half a phrase, of 24 offsets, then single windows.

Each level is a group aggregate that combines before it shuffles, over distinct phrases weighted by
their number of occurrences.  So groups of copies, however large, are never gathered, and no level
forms pairs.

Defined cases: null is the empty text; texts shorter than ``length`` lose nothing; matches never
cross documents; equal rows are separate documents (so they remove each other); an empty table
gives an empty result; other columns travel packed in one struct.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from astroframe.llm.common import bitmap, content_key, in_bitmap, stored

LENGTH = 400
GRAM = 16
BLOCK = 24
#: texts are parsed in overlapping pieces of this many windows, so that memory is bounded
PIECE = 1 << 20
PLACE_BITS = 24

PHRASES = "k1 long, k2 long, core long, lo int, hi int, span long, at array<long>"


def triggers(raw: bytes, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(trigger, first, last) of each run of windows ``[i, i + length)`` that share a trigger.

    The trigger of a window is the first of its smallest 16-byte hashes (compared on 40 bits).
    """
    windows = len(raw) - length + 1
    eight = np.ndarray((len(raw) - 7,), dtype="<u8", buffer=raw, strides=(1,))
    h = eight[:-8] * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(32)
    h += eight[8:] * np.uint64(0xC2B2AE3D27D4EB4F)
    h *= np.uint64(0x165667B19E3779F9)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0x9E3779B97F4A7C15)
    h &= np.uint64(~((1 << PLACE_BITS) - 1) & (1 << 64) - 1)
    h |= np.arange(len(h), dtype=np.uint64)
    span = length - GRAM + 1
    blocks = -(-len(h) // span)
    padded = np.full(blocks * span, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[:len(h)] = h
    grid = padded.reshape(blocks, span)
    down = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    up = np.minimum.accumulate(grid, axis=1).ravel()
    at = np.minimum(down[:windows], up[span - 1:span - 1 + windows]) & np.uint64((1 << PLACE_BITS) - 1)
    first = np.concatenate([[0], np.nonzero(at[1:] != at[:-1])[0] + 1])
    last = np.concatenate([first[1:] - 1, [windows - 1]])
    return at[first].astype(np.int64), first, last


def half(length: int) -> int:
    """Offsets (window start minus trigger) below this belong to the left half of a phrase."""
    return -(length - GRAM) // 2


def phrases(raw: bytes, length: int = LENGTH) -> dict[tuple[int, int, int, int], list[int]]:
    """(core hash, least offset, largest offset, span hash) -> places of the triggers, for one text.

    Offsets of a phrase are cut at the middle, so that the core of each half is about length / 2 bytes.
    """
    out: dict[tuple[int, int, int, int], list[int]] = {}
    middle, least = half(length), GRAM - length
    digest = xxhash.xxh3_64_intdigest
    for base in range(0, len(raw) - length + 1, PIECE):
        piece = raw[base:base + PIECE + length - 1]
        for a, i, j in zip(*(x.tolist() for x in triggers(piece, length))):
            lo, hi = i - a, j - a
            if lo < middle:
                top = min(hi, middle - 1)
                key = (digest(piece[a + middle - 1:a + least + length], 1), lo, top, digest(piece[i:a + top + length]))
                out.setdefault(key, []).append(base + a)
            if hi >= middle:
                low = max(lo, middle)
                key = (digest(piece[a:a + middle + length], 2), low, hi, digest(piece[a + low:j + length]))
                out.setdefault(key, []).append(base + a)
    return out


def parse(docs: DataFrame, length: int) -> DataFrame:
    """The parse of the texts (columns k1, k2, text): one row per document and distinct phrase of it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols: list[list] = [[] for _ in range(7)]
            for k1, k2, text in zip(*(batch.column(i) for i in range(3))):
                raw = (text.as_py() or "").encode("utf-8", "surrogatepass")
                if len(raw) < length:
                    continue
                k1, k2 = k1.as_py(), k2.as_py()
                for (core, lo, hi, span), at in phrases(raw, length).items():
                    for c, v in zip(cols, (k1, k2, core, lo, hi, span, at)):
                        c.append(v)
            kinds = [pa.int64(), pa.int64(), pa.uint64(), pa.int32(), pa.int32(), pa.uint64(), pa.list_(pa.int64())]
            arrays = [pa.array(c, k) for c, k in zip(cols, kinds)]
            arrays = [x.view(pa.int64()) if k == pa.uint64() else x for x, k in zip(arrays, kinds)]
            yield pa.RecordBatch.from_arrays(arrays, names=["k1", "k2", "core", "lo", "hi", "span", "at"])

    return docs.mapInArrow(run, PHRASES)


def shared_cores(items: DataFrame, core: str, same: Column, n: Column) -> DataFrame:
    """Cores that occur twice or more: (core, mixed); mixed means that their spans differ."""
    found = items.select(core, same.alias("_s"), n.alias("_n")).groupBy(core).agg(
        F.sum("_n").alias("n"), F.min("_s").alias("a"), F.max("_s").alias("b"))
    return found.where(F.col("n") >= 2).select(core, (F.col("a") != F.col("b")).alias("mixed"))


def repeated_spans(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Repeated stretches by row key: k1, k2, ``starts`` and ``ends`` (byte offsets, unmerged).

    ``docs`` has k1, k2 (a key of the row's content) and text.
    """
    spark = docs.sparkSession
    parsed = stored(parse(docs.select("k1", "k2", "text"), length), "phrases")
    cores = stored(shared_cores(parsed, "core", F.xxhash64("lo", "hi", "span"), F.size("at")), "cores")
    live = stored(parsed.join(cores, "core"), "live")

    # distinct phrases that need a closer look, each with its bytes from one of its places
    cid = ["core", "lo", "hi", "span"]
    odd = live.where("mixed").groupBy(*cid).agg(
        F.sum(F.size("at")).alias("n"), F.min(F.struct("k1", "k2", F.col("at")[0].alias("a"))).alias("one"))
    odd = stored(odd.select(*cid, "n", F.col("one.k1").alias("k1"), F.col("one.k2").alias("k2"), F.col("one.a").alias("a")), "odd")
    n_odd = odd.count()
    whole = live.where(~F.col("mixed")).select("k1", "k2", "at", "lo", "hi")
    if n_odd:
        bm = spark.sparkContext.broadcast(bitmap(odd, "k1", n_odd))

        @F.pandas_udf("boolean")
        def maybe(keys: pd.Series) -> pd.Series:
            return pd.Series(in_bitmap(bm.value, keys.to_numpy().astype(np.int64).view(np.uint64)))

        texts = docs.where(maybe("k1")).select("k1", "k2", F.col("text").cast("binary").alias("raw")).dropDuplicates(["k1", "k2"])
        start = (F.col("a") + F.col("lo") + 1).cast("int")
        size = F.col("hi") - F.col("lo") + length
        book = stored(odd.join(texts, ["k1", "k2"]).select(*cid, "n", F.substring("raw", start, size).alias("raw")), "dictionary")

        least = GRAM - length
        blocks = F.sequence(F.floor((F.col("lo") - least) / BLOCK).cast("int"), F.floor((F.col("hi") - least) / BLOCK).cast("int"))
        kids = book.select(*cid, "n", "raw", F.explode(blocks).alias("block"))
        kids = kids.withColumn("from", F.col("block") * BLOCK + least).withColumn("to", F.least(F.col("from") + (BLOCK - 1), F.lit(0)))
        kids = kids.withColumns({"i": F.greatest("from", "lo"), "j": F.least("to", "hi")})

        def cut(first: Column, last: Column) -> Column:
            """Bytes of the windows' common part (first = largest offset) or whole span (first = smallest)."""
            return F.substring("raw", first - F.col("lo") + 1, last - first + length)

        kids = kids.select(*cid, "n", "i", "j", F.xxhash64("block", cut(F.col("to"), F.col("from"))).alias("core2"),
                           F.xxhash64("i", "j", cut(F.col("i"), F.col("j"))).alias("same"))
        cores2 = stored(shared_cores(kids, "core2", F.col("same"), F.col("n")), "cores2")
        kids = stored(kids.join(cores2, "core2"), "blocks")

        ranges = kids.where("mixed").groupBy(*cid).agg(F.collect_list(F.struct("i", "j", "core2")).alias("r"))
        single = book.join(ranges, cid).select(*cid, "n", "raw", F.explode("r").alias("r"))
        single = single.select(*cid, "n", "raw", "r.core2", F.explode(F.sequence("r.i", "r.j")).alias("o"))
        single = single.select(*cid, "n", "core2", "o", F.xxhash64("o", cut(F.col("o"), F.col("o"))).alias("w"))
        single = stored(single, "windows")
        twice = stored(single.groupBy("core2", "w").agg(F.sum("n").alias("m")).where("m >= 2").select("core2", "w"), "repeated")
        single = single.join(twice, ["core2", "w"], "left_semi").select(*cid, F.col("o").alias("i"), F.col("o").alias("j"))
        found = kids.where(~F.col("mixed")).select(*cid, "i", "j").unionByName(single)
        # written first, so that the join below can split a phrase that very many documents share
        found = stored(found.groupBy(*cid).agg(F.collect_list(F.struct("i", "j")).alias("r")), "ranges")
        parts = live.where("mixed").join(found, cid).select("k1", "k2", "at", F.explode("r").alias("r"))
        whole = whole.unionByName(parts.select("k1", "k2", "at", F.col("r.i").alias("lo"), F.col("r.j").alias("hi")))
    spans = whole.select("k1", "k2", F.explode("at").alias("a"), "lo", "hi")
    spans = spans.select("k1", "k2", F.struct((F.col("a") + F.col("lo")).alias("s"), (F.col("a") + F.col("hi") + length).alias("e")).alias("x"))
    spans = spans.groupBy("k1", "k2").agg(F.collect_set("x").alias("x"))
    return spans.select("k1", "k2", F.col("x.s").alias("starts"), F.col("x.e").alias("ends"))


def cut_out(raw: bytes, starts, ends) -> tuple[int, int, bytes]:
    """(removed bytes, maximal removed runs, what remains) of a text and its unmerged stretches."""
    if starts is None or len(starts) == 0:
        return 0, 0, raw
    order = np.argsort(starts, kind="stable")
    s, e = np.asarray(starts)[order], np.maximum.accumulate(np.asarray(ends)[order])
    new = np.concatenate([[True], s[1:] > e[:-1]])
    runs = list(zip(s[new].tolist(), e[np.concatenate([np.nonzero(new)[0][1:] - 1, [len(e) - 1]])].tolist()))
    kept, at = [], 0
    for a, b in runs:
        kept.append(raw[at:a])
        at = b
    kept.append(raw[at:])
    return sum(b - a for a, b in runs), len(runs), b"".join(kept)


def remove_repeated(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", carry: list[str] | None = None,
                    length: int = LENGTH) -> DataFrame:
    """One row per document: ``doc`` (carried columns), ``n_bytes``, ``n_removed``, ``n_spans``, ``kept`` (binary)."""
    if length < 4 * GRAM:
        raise ValueError(f"length must be at least {4 * GRAM} bytes")
    cols = docs.columns if carry is None else carry
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in cols]).alias("doc"), F.coalesce(F.col(text), F.lit("")).alias("text"),
                       *content_key(doc_id, text))
    spans = stored(repeated_spans(rows, length), "spans")

    @F.pandas_udf("n_removed long, n_spans long, kept binary")
    def removed(raw: pd.Series, starts: pd.Series, ends: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([cut_out(bytes(r), s, e) for r, s, e in zip(raw, starts, ends)], columns=["n_removed", "n_spans", "kept"])

    out = rows.join(spans, ["k1", "k2"], "left").select("doc", F.col("text").cast("binary").alias("raw"), "starts", "ends")
    out = out.withColumn("x", removed("raw", "starts", "ends"))
    return out.select("doc", F.octet_length("raw").cast("long").alias("n_bytes"), "x.n_removed", "x.n_spans", "x.kept")
