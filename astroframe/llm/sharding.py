"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

Method: documents and ``vnodes`` virtual nodes per shard lie on a ring; a document belongs to
the first virtual node clockwise.  A shard takes its own documents in ring order up to its
capacity; documents of a full shard continue clockwise to the next virtual node whose shard
has room.  With ``slack`` 0 the capacities add up to the number of documents, so counts differ
by one at most (law ``rows``); with more slack fewer documents move when a shard is added.

The ring has 65,536 cells.  Documents are counted by cell and the overflow is worked out over
those counts; a document then finds its shard from its rank within its cell.  Ranks come from a
range sort, so equal ids or texts that hold a third of all rows are cut into even slices.

Defined cases: a null text counts as the empty text; a null id has one place on the ring like any
other id; equal rows are told apart by their place in the scan; an empty table gives an empty result.
"""

from __future__ import annotations

import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from astroframe.llm.common import in_order, stored, with_rank

CELLS = 1 << 16
VNODES = 64
OVERHEAD = 8
LAW = "rows"


def ring(shards: int, vnodes: int = VNODES) -> list[tuple[int, int]]:
    """The virtual nodes as (cell, shard), in ring order."""
    return sorted((xxhash.xxh64_intdigest(f"shard {s} node {v}") % CELLS, s) for s in range(shards) for v in range(vnodes))


def capacities(n: int, shards: int, slack: float = 0.0) -> list[int]:
    if slack <= 0:
        return [n // shards + (s < n % shards) for s in range(shards)]
    return [-(-int(n * (1 + slack) + 1) // shards)] * shards


def place_cells(counts: dict[int, int], shards: int, vnodes: int = VNODES, slack: float = 0.0) -> list[tuple[int, int, int, int]]:
    """Where each cell's documents go: pieces (cell, from, shard, slot) in ring order.

    Documents ``from`` onward of the cell (up to the next piece) fill the shard's slots from
    ``slot``.  Works on at most 65,536 counts, whatever the number of documents.
    """
    nodes = ring(shards, vnodes)
    room = capacities(sum(counts.values()), shards, slack)
    cells = sorted(counts)
    first, at = {}, 0
    for c in cells:
        while at < len(nodes) and nodes[at][0] < c:
            at += 1
        first[c] = at % len(nodes)
    own = {}
    for c in cells:
        shard = nodes[first[c]][1]
        own[c] = min(counts[c], room[shard])
        room[shard] -= own[c]
    used, out = [0] * shards, []

    def put(cell: int, start: int, n: int, shard: int) -> None:
        out.append((cell, start, shard, used[shard]))
        used[shard] += n

    for c in cells:
        if own[c]:
            put(c, 0, own[c], nodes[first[c]][1])
        start, at = own[c], first[c]
        while start < counts[c]:
            at = (at + 1) % len(nodes)
            n = min(counts[c] - start, room[nodes[at][1]])
            if n:
                room[nodes[at][1]] -= n
                put(c, start, n, nodes[at][1])
                start += n
    return out


def shard_documents(docs: DataFrame, shards: int, doc_id: str = "doc_id", text: str = "text", carry: list[str] | None = None,
                    vnodes: int = VNODES, slack: float = 0.0) -> DataFrame:
    """One row per document: ``doc`` (carried columns), ``size``, ``text_crc32``, ``shard``, ``slot``."""
    cols = docs.columns if carry is None else carry
    t = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in cols]).alias("doc"),
                       (F.octet_length(t) + OVERHEAD).cast("long").alias("size"), F.crc32(t).alias("text_crc32"),
                       F.xxhash64(F.col(doc_id).isNull(), F.col(doc_id)).alias("at"), F.xxhash64(t).alias("h"),
                       F.monotonically_increasing_id().alias("row"))
    placed = stored(in_order(rows, "at", "h", "row"), "ring").withColumn("cell", F.shiftright("at", 48).cast("int") + CELLS // 2)
    counts = {r["cell"]: r["n"] for r in placed.groupBy("cell").agg(F.count("*").alias("n")).collect()}
    base, total = {}, 0
    for c in sorted(counts):
        base[c] = total
        total += counts[c]
    pieces: dict[int, list[tuple[int, int, int]]] = {}
    for cell, start, shard, slot in place_cells(counts, shards, vnodes, slack):
        pieces.setdefault(cell, []).append((start, shard, slot))
    where = docs.sparkSession.createDataFrame(
        [(c, base[c], p) for c, p in pieces.items()],
        "cell int, cell_base long, pieces array<struct<start: long, shard: int, slot: long>>")
    out = with_rank(placed).join(F.broadcast(where), "cell")
    out = out.withColumn("nth", F.col("rank") - F.col("cell_base"))
    out = out.withColumn("piece", F.element_at(F.filter("pieces", lambda p: p["start"] <= F.col("nth")), -1))
    return out.select("doc", "size", "text_crc32", F.col("piece.shard").alias("shard"),
                      (F.col("piece.slot") + F.col("nth") - F.col("piece.start")).alias("slot"))
