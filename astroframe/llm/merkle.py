"""Merkle dataset manifest by time-forward processing.

Every row is a leaf; per group (``lang``) the leaves, in document order, are hashed two by two up to a
sub-root, and the sub-roots likewise up to the root.  The tree is a graph whose nodes are worked off in
the order of their labels (height, place): a node sends its digest forward in a message that bears its
parent's label, and a priority queue ordered by label hands each parent the digests of its children.  A
second sweep in the opposite order sends each child the rest of its proof: its sibling, then what its
parent received.

The queue is external.  Labels are cut into blocks of ``2**BLOCK`` leaves of one height; messages between
blocks lie in written tables and reach their block through Spark's shuffle by label, and a task keeps the
messages of one block in a heap.  A round of blocks climbs ``BLOCK`` heights, so 10**12 leaves take four
rounds up and four down, no task holds more than a block, and the driver holds the root alone.

Defined cases: nulls in any column are leaves' values like others; a null group comes first, a null
document id first in its group; rows that agree in all of the leaf's columns are leaves of their own with one
digest; an empty table has no root and gives no rows.  Texts of any length are hashed in the JVM and never
reach Python.  Other columns are carried in a struct ``doc``, so their names cannot clash.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from astroframe.llm.common import in_order, stored

#: heights that one block climbs: 2**10 leaves a block
BLOCK = 10
LEAF_COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]
STEP = r"[LR][0-9a-f]{64}|\."


def value(col: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, a colon and the value."""
    text = col.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(columns: dict[str, Column]) -> Column:
    """SHA-256 (hex) of the values of a row, in the given order."""
    return F.sha2(F.concat(*[value(c) for c in columns.values()]), 256)


def joined(digests: list[str]) -> str:
    return hashlib.sha256("".join(digests).encode()).hexdigest()


Label = tuple[int, int]  # height, place


def ascend(leaves: list[str], height: int) -> dict[Label, list[str]]:
    """The digests that each node of a block receives from its children, by label; the top is (height, 0).

    The queue is popped in label order; the messages of one label are one node's children.
    """
    queue = [((1, place >> 1), place, digest) for place, digest in enumerate(leaves)]
    children: dict[Label, list[str]] = {}
    while queue:
        label, _, digest = heapq.heappop(queue)
        children.setdefault(label, []).append(digest)
        if not queue or queue[0][0] != label:
            level, place = label
            if level < height:
                heapq.heappush(queue, ((level + 1, place >> 1), place, joined(children[label])))
    return children


def descend(children: dict[Label, list[str]], height: int, rest: str) -> list[str]:
    """The proof suffix of each leaf of a block whose top has the suffix ``rest``.

    The reversed sweep: labels are popped from the top down, and each child receives its sibling (``L`` or
    ``R`` of it, or ``.`` if it has none) before its parent's suffix.
    """
    queue = [(-height, 0, rest)]
    out: list[str] = []
    while queue:
        level, place, suffix = heapq.heappop(queue)
        own = children[-level, place]
        steps = ["."] if len(own) == 1 else ["R" + own[1], "L" + own[0]]
        for i, step in enumerate(steps):
            if level == -1:
                out.append(step + suffix)
            else:
                heapq.heappush(queue, (level + 1, 2 * place + i, step + suffix))
    return out


def climb(n: int, block: int) -> int:
    """Heights that a block of a tree with ``n`` nodes climbs: to the root if the tree fits, else ``block``."""
    return min(block, (n - 1).bit_length())


NODES = "tree string, place long, n long, digest string"


def parents(nodes: DataFrame, block: int) -> DataFrame:
    """One round up: the nodes that stand ``block`` heights above (or a tree's root)."""

    def run(key: tuple, part: pa.Table) -> pa.Table:
        part = part.sort_by("place")
        n = part["n"][0].as_py()
        height = climb(n, block)
        digests = part["digest"].to_pylist()
        top = joined(ascend(digests, height)[height, 0]) if height else digests[0]
        return pa.table({"tree": part["tree"][:1], "place": [part["place"][0].as_py() >> block], "n": [-(-n >> block) if n > 1 << block else 1],
                         "digest": [top]}, schema=pa.schema([("tree", pa.string()), ("place", pa.int64()), ("n", pa.int64()), ("digest", pa.string())]))

    return nodes.withColumn("block", F.shiftright("place", block)).groupBy("tree", "block").applyInArrow(run, NODES)


def suffixes(nodes: DataFrame, above: DataFrame, block: int) -> DataFrame:
    """One round down: every node's proof suffix, from the ``rest`` that its block's top received.

    ``above`` has a row (tree, place, rest, subroot) for each block; ``nodes`` may carry more columns.
    """
    blocks = above.select(F.col("tree").alias("_tree"), F.col("place").alias("_block"), "rest", "subroot")
    shaped = nodes.withColumn("block", F.shiftright("place", block))
    joined_up = shaped.join(blocks, (F.col("tree") == F.col("_tree")) & (F.col("block") == F.col("_block"))).drop("_tree", "_block")
    out = nodes.withColumns({"rest": F.lit(""), "subroot": F.lit("")}).schema
    names = out.names

    def run(part: pa.Table) -> pa.Table:
        part = part.sort_by("place")
        height = climb(part["n"][0].as_py(), block)
        rest = part["rest"][0].as_py()
        found = descend(ascend(part["digest"].to_pylist(), height), height, rest) if height else [rest]
        part = part.drop_columns(["rest"]).append_column("rest", pa.array(found, pa.string()))
        return part.select(names)

    return joined_up.groupBy("tree", "block").applyInArrow(run, out)


def rounds_up(nodes: DataFrame, largest: int, block: int) -> list[DataFrame]:
    """The node tables of all rounds: ``nodes`` first, one row a tree last."""
    levels = [nodes]
    while largest > 1:
        nodes = stored(parents(nodes.select("tree", "place", "n", "digest"), block), "merkle_nodes")
        levels.append(nodes)
        largest = -(-largest >> block) if largest > 1 << block else 1
    return levels


def numbered(leaves: DataFrame) -> DataFrame:
    """Each leaf's place in its tree (``tree``) and the tree's size ``n``, from one range sort of all leaves."""
    placed = stored(in_order(leaves, "tree", "key", "digest", F.monotonically_increasing_id()), "merkle_order")
    runs = placed.groupBy("part", "tree").agg(F.min("idx").alias("first"), F.count(F.lit(1)).alias("own"))
    every = Window.partitionBy("tree")
    runs = runs.select("part", "tree", F.sum("own").over(every).alias("n"), (F.sum("own").over(every.orderBy("part")) - F.col("own") - F.col("first")).alias("shift"))
    return placed.join(stored(runs, "merkle_runs"), ["part", "tree"]).withColumn("place", F.col("idx") + F.col("shift")).drop("part", "idx", "shift", "key")


def manifest(docs: DataFrame, tampered: Callable[[dict[str, Column]], dict[str, Column]] | None = None, group: str = "lang", key: str = "doc_id",
             columns: list[str] | None = None, carry: list[str] | None = None, block: int = BLOCK) -> DataFrame:
    """One row per document: ``doc`` (the carried columns), ``leaf``, ``subroot``, ``root`` and ``proof``.

    ``proof`` is the list of steps from the leaf to the root, each ``L`` or ``R`` and the digest of the sibling that
    stands there, or ``.`` where the node has no sibling.  ``tampered`` maps the leaf's columns to changed ones;
    their digest is then in ``shown``, the leaf that a verifier is handed (else the leaf itself).
    """
    cols = {c: F.col(c) for c in columns or LEAF_COLUMNS}
    shown = leaf_digest(tampered(cols)) if tampered else leaf_digest(cols)
    leaves = docs.select(F.coalesce(F.concat(F.lit("v"), F.col(group).cast("string")), F.lit("n")).alias("tree"), F.col(key).alias("key"),
                         leaf_digest(cols).alias("digest"), shown.alias("shown"), F.struct(*(carry or docs.columns)).alias("doc"))
    leaves = stored(numbered(stored(leaves, "merkle_leaves")), "merkle_places")
    largest = leaves.agg(F.max("n")).first()[0]
    out = leaves.withColumns({"leaf": F.col("digest"), "rest": F.lit(""), "subroot": F.lit(""), "root": F.lit("")})
    if largest is not None:
        levels = rounds_up(leaves, largest, block)
        roots = levels[-1].select(F.lit("").alias("tree"), F.col("tree").alias("key"), "digest")
        tops = stored(numbered(roots.withColumn("name", F.col("key"))), "merkle_tops")
        top_levels = rounds_up(tops, tops.count(), block)
        root = top_levels[-1].first()["digest"]
        rest = top_levels[-1].select("tree", F.col("place"), F.lit("").alias("rest"), F.lit("").alias("subroot"))
        for nodes in reversed(top_levels[:-1]):
            rest = suffixes(nodes, rest, block)
        if len(top_levels) == 1:
            rest = tops.withColumns({"rest": F.lit(""), "subroot": F.lit("")})
        rest = stored(rest.select(F.col("name").alias("tree"), F.lit(0).cast("long").alias("place"), "rest", F.col("digest").alias("subroot")), "merkle_rest")
        for nodes in reversed(levels[1:-1]):
            rest = stored(suffixes(nodes, rest, block).select("tree", "place", "rest", "subroot"), "merkle_rest")
        if len(levels) > 1:
            out = suffixes(leaves, rest, block)
        else:
            out = leaves.join(rest.select("tree", "rest", "subroot"), "tree")
        out = out.withColumns({"leaf": F.col("digest"), "root": F.lit(root)})
    return out.select("doc", "leaf", "shown", "subroot", "root", F.regexp_extract_all("rest", F.lit(f"({STEP})")).alias("proof"))


def proof_digest(proof: str | Column) -> Column:
    """SHA-256 of the siblings of a proof, in its order (of nothing if there are none)."""
    siblings = F.transform(F.col(proof) if isinstance(proof, str) else proof, lambda s: F.regexp_replace(s, r"[LR.]", ""))
    return F.sha2(F.array_join(siblings, ""), 256)


def folded(leaf: str, proof: str) -> Column:
    """The root that a leaf and its proof lead to."""
    def step(digest: Column, s: Column) -> Column:
        sibling = F.substring(s, 2, 64)
        return F.sha2(F.when(s.startswith("L"), F.concat(sibling, digest)).when(s.startswith("R"), F.concat(digest, sibling)).otherwise(digest), 256)

    return F.aggregate(F.col(proof), F.col(leaf), step)


def add_one(columns: dict[str, Column]) -> dict[str, Column]:
    """One more character claimed (nulls stay) where 7 divides the CRC-32 of the decimal document id."""
    hit = F.crc32(columns["doc_id"].cast("string").cast("binary")) % 7 == 0
    more = (columns["n_chars"].cast("decimal(38,0)") + 1).cast("string")
    return columns | {"n_chars": F.when(hit, more).otherwise(columns["n_chars"].cast("string"))}


def verified_manifest(docs: DataFrame, **options) -> DataFrame:
    """The manifest with the digests that the contract asks for: proof_sha256, folded_root, verified."""
    out = manifest(docs, add_one, **options)
    out = out.withColumns({"proof_sha256": proof_digest("proof"), "folded_root": folded("shown", "proof")})
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
