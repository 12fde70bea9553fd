"""Ranked lexical search by pipelined term partitioning.

The terms of the queries ("items") are dealt to a few owners, rare terms first.  An owner holds the posting lists
of its terms; item bundles carry sparse accumulators (document, score so far) through the owners one after the
other, each stage a cogroup of the bundles with the owner's postings, and every owner adds integer
contributions.  After the last owner the best documents of each item are selected.

* Documents are numbered within slices of at most ``SLICE`` rows as their texts are read, and items within blocks
  of ``ITEM_BLOCK``; bundles and postings meet by (slice, block), so a term in every document, or an item that
  meets every document, is spread over all slices and a task holds one slice's accumulators.
* After each stage the k-th best partial score of an item, over all slices, is a lower bound of its final k-th score.  An
  accumulator that cannot reach it with all that later owners can still add (a term's weight times its
  largest contribution) is dropped, and an item whose remaining terms alone cannot reach it takes no new
  documents.  Both tests are strict, so the result, ties included, is that of a full evaluation.
* Only terms that items hold become postings: a hash bitmap of bounded size goes to the tasks, and its false
  positives fall away in the join with the terms.

Defined cases: a null text, of a document or an item, has no terms; each row of either table is a document or
item of its own, also where rows repeat; documents of a null id come after others of their score; empty
tables give an empty result; long texts are split into terms part by part.  Only the named columns are read.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from astroframe.llm.common import bitmap, in_order, stored, with_rank

SLICE = 4096
SLICE_POSTINGS = 500_000
ITEM_BLOCK = 256
OWNERS = 4
#: bytes of a text that are split into terms at once
PART = 1 << 20
#: a term's bytes: 0-9, A-Z as a-z, a-z, and all of a non-ASCII character; all else separates
TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
#: entries of a task's table of terms already looked up
KNOWN = 1 << 18


def term_counts(text: bytes | None) -> Counter:
    """Occurrences of each term of a UTF-8 text."""
    counts: Counter = Counter()
    if text is not None:
        text = text.translate(TERM_BYTES)
        at = 0
        while at < len(text):
            end = text.find(b" ", at + PART)
            end = len(text) if end < 0 else end
            counts.update(text[at:end].split())
            at = end
    return counts


class Slice:
    """Posting lists of the documents of one slice, in the making."""

    def __init__(self, number: int):
        self.number, self.postings, self.size = number, {}, 0
        self.ids: list = []
        self.lengths: list[int] = []

    def add(self, doc_id, length: int, hits: list[tuple[bytes, int]]) -> None:
        place = len(self.ids)
        self.ids.append(doc_id)
        self.lengths.append(length)
        self.size += len(hits)
        for term, tf in hits:
            self.postings.setdefault(term, ([], []))
            places, tfs = self.postings[term]
            places.append(place)
            tfs.append(tf)

    def full(self, docs: int) -> bool:
        return len(self.ids) >= docs or self.size >= SLICE_POSTINGS

    def batch(self, schema: pa.Schema) -> pa.RecordBatch:
        """A row for each term, and one (term null) with all the documents' ids and lengths."""
        lengths = np.array(self.lengths, dtype=np.int64)
        rows = len(self.postings) + 1
        places = [p for p, _ in self.postings.values()] + [list(range(len(self.ids)))]
        return pa.RecordBatch.from_arrays([
            pa.array([self.number] * rows, pa.int64()), pa.array([t.decode("utf-8", "replace") for t in self.postings] + [None], pa.string()),
            pa.array(places, schema.field("places").type), pa.array([tf for _, tf in self.postings.values()] + [None], schema.field("tfs").type),
            pa.array([lengths[p] for p in places], schema.field("lengths").type),
            pa.array([None] * (rows - 1) + [self.ids], schema.field("doc_ids").type)], schema=schema)


def index_slices(docs: DataFrame, wanted: np.ndarray, doc_id: str, text: str, slice_docs: int) -> DataFrame:
    """The written index: (slice, term, places, tfs, lengths) and a row of documents (places, lengths, doc_ids) per slice."""
    kind = docs.schema[doc_id].dataType
    shape = T.StructType([T.StructField("slice", T.LongType()), T.StructField("term", T.StringType()), T.StructField("places", T.ArrayType(T.IntegerType())),
                          T.StructField("tfs", T.ArrayType(T.LongType())), T.StructField("lengths", T.ArrayType(T.LongType())),
                          T.StructField("doc_ids", T.ArrayType(kind))])
    shared = docs.sparkSession.sparkContext.broadcast(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        from pyspark.sql.pandas.types import to_arrow_schema

        schema = to_arrow_schema(shape)
        bits, known = shared.value, {}
        mask = len(bits) * 32 - 1
        number = TaskContext.get().partitionId() << 32
        held = Slice(number)

        def is_wanted(term: bytes) -> bool:
            if len(known) >= KNOWN:
                known.clear()
            place = zlib.crc32(term) & mask
            known[term] = found = bool(int(bits[place >> 5]) >> (place & 31) & 1)
            return found

        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            for ident, content in zip(batch.column(0), texts):
                counts = term_counts(content.as_py())
                hits = [(t, n) for t, n in counts.items() if (known[t] if t in known else is_wanted(t))]
                held.add(ident.as_py(), counts.total(), hits)
                if held.full(slice_docs):
                    yield held.batch(schema)
                    number += 1
                    held = Slice(number)
        if held.ids:
            yield held.batch(schema)

    return stored(docs.select(doc_id, text).mapInArrow(run, shape), "postings")


def item_terms(items: DataFrame, item_id: str, text: str, block: int) -> tuple[DataFrame, DataFrame]:
    """Written tables of the items (block, item, item_id) and of their distinct terms (block, item, term)."""
    keyed = stored(items.select(F.col(item_id).alias("item_id"), F.col(text).cast("binary").alias("text")), "items")
    ranked = stored(with_rank(stored(in_order(keyed, "item_id", "text", F.monotonically_increasing_id()), "item_order")), "item_ranks")
    placed = ranked.select(F.floor(F.col("rank") / block).cast("long").alias("block"), (F.col("rank") % block).cast("int").alias("item"), "item_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                found = [t.decode("utf-8", "replace") for t in term_counts(batch.column("text")[i].as_py())]
                yield pa.RecordBatch.from_arrays([pa.array([batch.column("block")[i].as_py()] * len(found), pa.int64()),
                                                  pa.array([batch.column("item")[i].as_py()] * len(found), pa.int32()), pa.array(found, pa.string())],
                                                 names=["block", "item", "term"])

    terms = placed.select("block", "item", "text").mapInArrow(run, "block long, item int, term string")
    return placed.drop("text"), stored(terms, "item_terms")


def contribution(tf: Column, m: Column) -> Column:
    """Exact integer contribution of a term before its weight."""
    return F.call_function("div", F.lit(1_000_000_000) * tf, 1000 * tf + 20 * m)


def slice_m(lengths: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """A document's m = 50 + (50 * n * N) div L; with Python integers where 64 bits would not hold the product."""
    if len(lengths) and int(lengths.max()) * 50 * n_docs >= 1 << 63:
        lengths = lengths.astype(object)
    return (50 + (50 * lengths * n_docs) // n_terms).astype(np.int64)


ACC = "array<struct<place:int,score:bigint>>"
BUNDLES = f"slice long, block long, item int, acc {ACC}, best array<bigint>"


def flat(lists: pa.ChunkedArray) -> tuple[pa.Array, np.ndarray]:
    """The values of a list column and the bounds of each row's."""
    column = lists.combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = column.chunk(0)
    lengths = np.array(column.value_lengths().to_pylist(), dtype=np.int64)
    return column.flatten(), np.concatenate([[0], np.cumsum(lengths)])


def numbers(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False)


def own_stage(k: int, n_docs: int, n_terms: int, last: bool):
    """The function of one owner: adds its terms' contributions to the accumulators of one (slice, block)."""

    def run(key: tuple, bundles: pa.Table, postings: pa.Table) -> pa.Table:
        slice_no, block = key[0].as_py(), key[1].as_py()
        shown = [numbers(bundles["item"].combine_chunks()).astype(np.int64)] if bundles.num_rows else []
        columns = {}
        if postings.num_rows:
            members, member_ends = flat(postings["items"])
            columns = {"item": numbers(members.field("item")).astype(np.int64), "open": numbers(members.field("open")), "ends": member_ends}
            shown.append(columns["item"])
            places, ends = flat(postings["places"])
            places, tf = numbers(places).astype(np.int64), numbers(flat(postings["tfs"])[0])
            m = slice_m(numbers(flat(postings["lengths"])[0]), n_docs, n_terms)
            gains = np.repeat(numbers(postings["weight"].combine_chunks()), np.diff(ends)) * ((1_000_000_000 * tf) // (1000 * tf + 20 * m))
        items = np.unique(np.concatenate(shown))
        width = 1 + int(places.max() if postings.num_rows and len(places) else 0)
        if bundles.num_rows:
            held, held_ends = flat(bundles["acc"])
            held_places = numbers(held.field("place")).astype(np.int64)
            width = max(width, 1 + int(held_places.max(initial=0)))
        scores = np.zeros((len(items), width), dtype=np.int64)
        if bundles.num_rows:
            rows = np.searchsorted(items, shown[0])
            scores[np.repeat(rows, np.diff(held_ends)), held_places] = numbers(held.field("score"))
        if postings.num_rows:
            rows = np.searchsorted(items, columns["item"])
            closed = np.unique(rows[~columns["open"].astype(bool)])  # no new documents: what was zero stays zero
            before = scores[closed] > 0
            for r in range(postings.num_rows):
                a, b = ends[r], ends[r + 1]
                mine = rows[columns["ends"][r]:columns["ends"][r + 1]]
                if len(mine) == 1:
                    scores[mine[0], places[a:b]] += gains[a:b]
                else:
                    scores[np.ix_(mine, places[a:b])] += gains[a:b]
            scores[closed] *= before
        return bundle_table(slice_no, block, items, scores, k, last)

    return run


def bundle_table(slice_no: int, block: int, items: np.ndarray, scores: np.ndarray, k: int, last: bool) -> pa.Table:
    """A row per item with an accumulator; ``best`` has its k best scores.  The last owner keeps what may be selected."""
    places, values, best = [], [], []
    for line in scores:
        found = np.flatnonzero(line)
        score = line[found]
        top = -np.sort(-(np.partition(score, len(score) - k)[len(score) - k:] if len(score) > k else score))
        if last and len(top) == k:
            keep = score >= top[-1]
            found, score = found[keep], score[keep]
        places.append(found)
        values.append(score)
        best.append(top)
    some = [i for i, p in enumerate(places) if len(p)]

    def lists(parts: list[np.ndarray], make) -> pa.Array:
        offsets = np.concatenate([[0], np.cumsum([len(parts[i]) for i in some])]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), make)

    def joined(parts: list[np.ndarray], kind) -> pa.Array:
        return pa.array(np.concatenate([parts[i] for i in some]) if some else np.empty(0, np.int64), kind)

    acc = pa.StructArray.from_arrays([joined(places, pa.int32()), joined(values, pa.int64())], names=["place", "score"])
    return pa.table({"slice": pa.array([slice_no] * len(some), pa.int64()), "block": pa.array([block] * len(some), pa.int64()),
                     "item": pa.array(items[some] if some else [], pa.int32()), "acc": lists(places, acc), "best": lists(best, joined(best, pa.int64()))})


def owner_bounds(volumes: list[tuple[int, int]], owners: int) -> list[int]:
    """Upper rarity class of every owner but the last, so that the owners' posting volumes are about equal."""
    total, seen, bounds = sum(v for _, v in volumes), 0, []
    for rarity, volume in sorted(volumes):
        seen += volume
        if len(bounds) < owners - 1 and seen * owners >= total * (len(bounds) + 1):
            bounds.append(rarity)
    return bounds


def search(docs: DataFrame, items: DataFrame, k: int = 50, owners: int = OWNERS, doc_id: str = "doc_id", text: str = "text",
           item_id: str = "item_id", item_text: str = "text", slice_docs: int = SLICE, item_block: int = ITEM_BLOCK) -> DataFrame:
    """The ``k`` highest-scoring documents of each item: item_id, rank (from 1), doc_id, score."""
    spark = docs.sparkSession
    named, own_terms = item_terms(items, item_id, item_text, item_block)
    hashed = own_terms.select(F.crc32(F.col("term").cast("binary")).alias("hash")).distinct()
    index = index_slices(docs, bitmap(hashed, "hash", hashed.count()), doc_id, text, slice_docs)
    sizes = index.where(F.col("term").isNull()).select("slice", F.explode("lengths").alias("n")).where("n > 0")
    n_docs, n_terms = sizes.agg(F.count(F.lit(1)), F.sum("n")).first()
    empty = spark.createDataFrame([], BUNDLES)
    last = empty
    if n_docs:
        lists = index.where(F.col("term").isNotNull()).drop("doc_ids")
        stats = lists.groupBy("term").agg(F.sum(F.size("places")).alias("df"), F.max(F.array_max("tfs")).alias("tf"), F.min(F.array_min("lengths")).alias("n"))
        weight = F.floor(1000 * F.log((2.0 * n_docs + 2) / (2.0 * F.col("df") + 1))).cast("long")
        least_m = 50 + F.call_function("div", (50 * F.col("n")).cast("decimal(20,0)") * F.lit(n_docs).cast("decimal(18,0)"), F.lit(n_terms).cast("decimal(20,0)"))
        stats = stats.select("term", "df", weight.alias("weight"), (weight * contribution(F.col("tf"), least_m)).alias("most"),
                             F.floor(4 * F.log2("df")).cast("int").alias("rarity"))
        terms = stored(own_terms.join(stats.where("weight > 0"), "term"), "term_owners")
        volumes = terms.select("term", "df", "rarity").distinct().groupBy("rarity").agg(F.sum("df")).collect()
        bounds = owner_bounds([tuple(v) for v in volumes], owners)
        owner = sum(((F.col("rarity") > b).cast("int") for b in bounds), F.lit(0))
        terms = terms.withColumn("owner", owner)
        reach = None
        for stage in range(len(bounds) + 1):
            rest = terms.groupBy("block", "item").agg(F.sum(F.when(F.col("owner") >= stage, F.col("most")).otherwise(0)).alias("room"))
            if reach is not None:
                rest = rest.join(reach, ["block", "item"], "left")
            rest = rest.withColumn("floor", F.coalesce(F.col("reached") if reach is not None else F.lit(None).cast("long"), F.lit(1)) - F.col("room"))
            rest = stored(rest.select("block", "item", "floor"), "item_floors")
            mine = terms.where(F.col("owner") == stage).join(rest, ["block", "item"])
            mine = mine.groupBy("term", "block", "weight").agg(F.collect_list(F.struct("item", (F.col("floor") <= 0).alias("open"))).alias("items"))
            postings = lists.join(stored(mine, "owned_terms"), "term").select("slice", "block", "weight", "items", "places", "tfs", "lengths")
            carried = last.join(rest, ["block", "item"]).withColumn("acc", F.filter("acc", lambda a: a["score"] >= F.col("floor")))
            carried = carried.where(F.size("acc") > 0).select("slice", "block", "item", "acc")
            run = own_stage(k, n_docs, n_terms, stage == len(bounds))
            last = carried.groupBy("slice", "block").cogroup(postings.groupBy("slice", "block")).applyInArrow(run, BUNDLES)
            last = stored(last, "bundles")
            if stage < len(bounds):
                reach = kth_best(last, k)
    found = last.select("slice", "block", "item", F.explode("acc").alias("a")).select("slice", "block", "item", "a.*")
    ids = index.where(F.col("term").isNull()).select("slice", "doc_ids")
    found = found.join(ids, "slice").select("block", "item", "score", F.col("doc_ids")[F.col("place")].alias("doc_id"))
    order = Window.partitionBy("block", "item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.join(named, ["block", "item"]).select("item_id", "rank", "doc_id", "score")


def kth_best(bundles: DataFrame, k: int) -> DataFrame:
    """Per item with at least ``k`` accumulators, the k-th best score over all slices."""
    scores = bundles.select("block", "item", F.explode("best").alias("score"))
    place = F.row_number().over(Window.partitionBy("block", "item").orderBy(F.desc("score")))
    best = scores.withColumn("nth", place).where(F.col("nth") <= k)
    return best.where(F.col("nth") == k).select("block", "item", F.col("score").alias("reached"))
