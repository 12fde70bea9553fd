"""Token-ID output: best-fit-decreasing packing into rows of fixed length.

Method: texts are encoded with a public tokenizer's rank file; documents longer than a row are
split into pieces (losslessly: a piece knows its document and first token); the pieces, longest first,
each go to the open row with the least sufficient room, which a segment tree over the
capacities finds in log(capacity) steps.  Rows leave as packed id matrices with cumulative
segment lengths and position resets; ``write_packs`` and ``read_packs`` keep them as Parquet.

Packing runs in groups of about ``group_tokens`` tokens, dealt by a hash, so that it is parallel and
a task holds a few megabytes of ids; within a group the result is exactly best-fit decreasing.

Defined cases: a null, or empty, text has no tokens and so no piece; equal rows are packed each; ties in
length go by document id (null first), row and piece; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from astroframe.llm.common import stored

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: fixed value: the public pattern that splits text before the merges of the rank files
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
CAPACITY = 2048
GROUP_TOKENS = 1_000_000
PAD = 0
#: longer texts are encoded in parts that end where a token must end
PART = 1 << 20
SAFE_CUT = re.compile(r"(?<=\S)(?= [^\W\d_])")

PIECES = "doc_id long, row long, piece int, first long, n int, ids binary"
PACKS = ("group int, pack int, n_tokens int, input_ids binary, position_ids binary, cu_seqlens array<int>, "
         "doc_ids array<long>, pieces array<int>, firsts array<long>")
PACK_COLUMNS = [c.split()[0] for c in PACKS.split(", ")]


@lru_cache(maxsize=2)
def encoder(rank_file: bytes) -> tiktoken.Encoding:
    ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in rank_file.splitlines() if line)}
    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@lru_cache(maxsize=2)
def token_type(rank_file: bytes) -> np.dtype:
    """Little-endian unsigned type of the ids: two bytes if they fit, else four (kept: the count reads the whole file)."""
    return np.dtype("<u2" if rank_file.count(b"\n") < 1 << 16 else "<u4")


def parts(text: str, size: int = PART) -> Iterator[str]:
    """The text in parts whose encodings, joined, are the encoding of the whole."""
    at = 0
    while len(text) - at > size:
        cut = SAFE_CUT.search(text, at + size)
        if cut is None:
            break
        yield text[at:cut.start()]
        at = cut.start()
    yield text[at:]


def encode(text: str | None, rank_file: bytes) -> np.ndarray:
    own = encoder(rank_file)
    found = [np.array(own.encode_ordinary(p), dtype=token_type(rank_file)) for p in parts(text or "") if p]
    return np.concatenate(found) if found else np.empty(0, token_type(rank_file))


def token_pieces(docs: DataFrame, rank_file: bytes, doc_id: str, text: str, capacity: int) -> DataFrame:
    """Encoded pieces of at most ``capacity`` tokens, one row each."""
    shared = docs.sparkSession.sparkContext.broadcast(rank_file)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = shared.value
        for batch in batches:
            out: list[tuple] = []
            size = 0
            for ident, row, content in zip(*(batch.column(i) for i in range(3))):
                ids = encode(content.as_py(), ranks)
                for piece, first in enumerate(range(0, len(ids), capacity)):
                    part = ids[first:first + capacity]
                    out.append((ident.as_py(), row.as_py(), piece, first, len(part), part.tobytes()))
                size += len(ids)
                if size > GROUP_TOKENS:
                    yield piece_batch(out)
                    out, size = [], 0
            if out:
                yield piece_batch(out)

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("row"), F.col(text).alias("text"))
    return rows.mapInArrow(run, PIECES)


def piece_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                                      names=["doc_id", "row", "piece", "first", "n", "ids"])


class CapacityTree:
    """Segment tree over capacities 0..top: how many open rows have each capacity left."""

    def __init__(self, top: int):
        self.base = 1 << top.bit_length()
        self.count = [0] * (2 * self.base)
        self.open: list[list[int]] = [[] for _ in range(top + 1)]

    def add(self, room: int, row: int, by: int = 1) -> None:
        node = self.base + room
        while node:
            self.count[node] += by
            node //= 2
        if by > 0:
            self.open[room].append(row)

    def take(self, need: int) -> tuple[int, int] | None:
        """(room, row) of the open row with the least room of at least ``need``, removed from the tree."""
        node = self.base + need
        if not self.count[node]:
            while node > 1 and (node & 1 or not self.count[node + 1]):
                node //= 2
            if node <= 1:
                return None
            node += 1
            while node < self.base:
                node = 2 * node if self.count[2 * node] else 2 * node + 1
        room = node - self.base
        row = self.open[room].pop()
        self.add(room, row, -1)
        return room, row


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Rows of piece numbers; ``lengths`` must come longest first."""
    tree, rows = CapacityTree(capacity), []
    for i, n in enumerate(lengths):
        found = tree.take(n)
        if found is None:
            rows.append([])
            found = capacity, len(rows) - 1
        room, row = found
        rows[row].append(i)
        if room > n:
            tree.add(room - n, row)
    return rows


def pack_group(pieces: pd.DataFrame, group: int, capacity: int, kind: np.dtype) -> pd.DataFrame:
    """One group's packed rows."""
    pieces = pieces.sort_values(["n", "doc_id", "row", "piece"], ascending=[False, True, True, True], na_position="first").reset_index(drop=True)
    positions = np.dtype("<u2" if capacity <= 1 << 16 else "<u4")
    out = []
    ids, n = pieces["ids"].tolist(), pieces["n"].tolist()
    docs, piece, first = (pieces[c].tolist() for c in ("doc_id", "piece", "first"))
    for pack, members in enumerate(best_fit(n, capacity)):
        ends = np.cumsum([n[i] for i in members])
        total = int(ends[-1])
        line = np.full(capacity, PAD, dtype=kind)
        line[:total] = np.frombuffer(b"".join(ids[i] for i in members), dtype=kind)
        place = np.zeros(capacity, dtype=positions)
        place[:total] = np.concatenate([np.arange(n[i]) for i in members])
        out.append((group, pack, total, line.tobytes(), place.tobytes(), [0, *ends.tolist()],
                    [None if pd.isna(docs[i]) else int(docs[i]) for i in members], [piece[i] for i in members], [first[i] for i in members]))
    return pd.DataFrame(out, columns=PACK_COLUMNS)


def pack(docs: DataFrame, rank_file: str = TOKENIZER, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY,
         group_tokens: int = GROUP_TOKENS) -> DataFrame:
    """Packed rows (columns ``PACKS``): ``input_ids`` and ``position_ids`` hold one matrix row of ``capacity`` little-endian
    numbers (padded with 0 after ``n_tokens``); ``cu_seqlens`` the segments' bounds; the rest which tokens they are.

    The rank file is read on the driver and broadcast (a tokenizer's vocabulary, of fixed size).
    """
    with open(rank_file, "rb") as f:
        ranks = f.read()
    kind = token_type(ranks)
    pieces = stored(token_pieces(docs, ranks, doc_id, text, capacity), "pieces")
    total = pieces.agg(F.sum("n")).first()[0] or 0
    groups = max(1, -(-total // group_tokens))
    dealt = pieces.withColumn("group", F.pmod(F.xxhash64("doc_id", "row", "piece"), F.lit(groups)).cast("int"))

    def run(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        return pack_group(part, int(key[0]), capacity, kind)

    return dealt.groupBy("group").applyInPandas(run, PACKS)


def write_packs(packs: DataFrame, path: str) -> None:
    """Writes packed rows (id and position matrices, segment bounds and sources) as Parquet; the path must be new."""
    packs.select(*PACK_COLUMNS).write.parquet(path)


def read_packs(spark: SparkSession, path: str) -> DataFrame:
    """The packed rows that ``write_packs`` wrote."""
    return spark.read.schema(PACKS).parquet(path)


def unpack(packs: DataFrame, rank_file: str = TOKENIZER) -> DataFrame:
    """The pieces back from packed rows: doc_id, piece, first, ids (array<int>)."""
    with open(rank_file, "rb") as f:
        kind = token_type(f.read())

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for row in batch.itertuples(index=False):
                ids = np.frombuffer(row.input_ids, dtype=kind)
                for a, b, d, p, f in zip(row.cu_seqlens[:-1], row.cu_seqlens[1:], row.doc_ids, row.pieces, row.firsts):
                    out.append((d, p, f, ids[a:b].astype(np.int32)))
            yield pd.DataFrame(out, columns=["doc_id", "piece", "first", "ids"]).astype({"doc_id": "Int64"})

    return packs.mapInPandas(run, "doc_id long, piece int, first long, ids array<int>")
