"""SimHash near-dedup by multi-index hashing.

Method: a text's fingerprint has a bit set where more than half of its shingles' hashes have it.
Fingerprints are split into segments; a table holds every fingerprint under each of its segment
values.  A query enumerates the small Hamming ball around each of its own segments, fetches the
table's matches and verifies the complete distance.  For a distance of r over m segments, with
r = m q + a, the first a + 1 segments need radius q and the others q - 1.

Table values shared by more than ``bucket`` different fingerprints are not joined pair by pair:
the fingerprints that hold or reach such a value enumerate the balls of radius r/2 around their
whole fingerprint, where two within distance r meet in at least one point, and link to the
smallest holder of each point.  No link is lost and the work stays linear in the fingerprints.

Defined cases: a null, empty or blank text has fingerprint zero and is linked like any other; a
null id takes part and is never a component id unless all ids of the component are null; equal
rows belong to one component; an empty table gives an empty result.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from astroframe.llm.common import stored

SHINGLE = 3
SEED = 42
MAX_BITS = 2
SEGMENTS = 2
BUCKET = 32
CHUNK = 1 << 15


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """SimHash of a whole text as an unsigned 64-bit integer."""
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return 0
    joined = b" ".join(found)
    if len(found) <= shingle:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum([len(w) + 1 for w in found]) - 1
    starts = [0, *(ends[:-1] + 1).tolist()]
    ends = ends.tolist()
    n, digest = len(found) - shingle + 1, xxhash.xxh64_digest
    ones = np.zeros(64, dtype=np.int64)
    for lo in range(0, n, CHUNK):
        hi = min(n, lo + CHUNK)
        raw = b"".join([digest(joined[a:b], SEED) for a, b in zip(starts[lo:hi], ends[lo + shingle - 1:hi + shingle - 1])])
        ones += np.unpackbits(np.frombuffer(raw, dtype=np.uint8).reshape(hi - lo, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def with_fingerprint(df: DataFrame, text: str, shingle: int = SHINGLE) -> DataFrame:
    """Adds ``fp``, the fingerprint as a signed long."""

    @F.pandas_udf("long")
    def prints(texts: pd.Series) -> pd.Series:
        found = np.fromiter((fingerprint(t, shingle) for t in texts), dtype=np.uint64, count=len(texts))
        return pd.Series(found.view(np.int64))

    return df.withColumn("fp", prints(F.col(text)))


def flips(bits: int, radius: int, shift: int = 0) -> list[int]:
    """All masks of at most ``radius`` of ``bits`` bits, as signed 64-bit numbers shifted left."""
    out = []
    for r in range(radius + 1):
        for places in combinations(range(bits), r):
            mask = sum(1 << (p + shift) for p in places)
            out.append(mask - (1 << 64) if mask >= 1 << 63 else mask)
    return out


def near_pairs(prints: DataFrame, max_bits: int = MAX_BITS, segments: int = SEGMENTS, bucket: int = BUCKET) -> DataFrame:
    """Edges (a, b) between different fingerprints whose components are those of distance <= ``max_bits``.

    ``prints`` has the distinct fingerprints (column fp).  Values held by at most ``bucket``
    fingerprints give every link; the others give star links (see the module's text).
    """
    width = 64 // segments
    q, extra = divmod(max_bits, segments)
    low = F.lit((1 << width) - 1)

    def value(k: int):
        return F.shiftrightunsigned("fp", 64 - width * (k + 1)).bitwiseAND(low)

    table = prints.select("fp", F.posexplode(F.array(*[value(k) for k in range(segments)])).alias("seg", "value"))
    counts = table.groupBy("seg", "value").agg(F.count("*").alias("n"))
    crowded = stored(counts.where(F.col("n") > bucket).select("seg", "value"), "crowded")
    probes = None
    for k in range(segments):
        radius = q if k <= extra else q - 1
        if radius < 0:
            continue
        ball = F.explode(F.array(*[F.lit(m).cast("long") for m in flips(width, radius)]))
        own = prints.select("fp", value(k).alias("own"), ball.alias("mask")).select(
            "fp", F.lit(k).alias("seg"), F.col("own").bitwiseXOR(F.col("mask")).alias("value"))
        probes = own if probes is None else probes.unionByName(own)

    quiet = table.withColumnRenamed("fp", "b").join(crowded, ["seg", "value"], "left_anti")
    pairs = (probes.withColumnRenamed("fp", "a").join(quiet, ["seg", "value"])
             .where((F.col("b") < F.col("a")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits))
             .select("a", "b"))
    if crowded.isEmpty():
        return pairs.distinct()

    reach = probes.join(crowded, ["seg", "value"], "left_semi").select("fp")
    holders = table.join(crowded, ["seg", "value"], "left_semi").select("fp")
    dense = stored(reach.unionByName(holders).distinct(), "dense")
    inner, outer = max_bits // 2, max_bits - max_bits // 2
    points = F.explode(F.array(*[F.struct(F.lit(m).cast("long").alias("mask"), F.lit(m.bit_count() <= inner if m >= 0 else
                                 (m + (1 << 64)).bit_count() <= inner).alias("holds")) for m in flips(64, outer)]))
    points = dense.select("fp", points.alias("p")).select("fp", F.col("fp").bitwiseXOR(F.col("p.mask")).alias("point"), "p.holds")
    least = points.where("holds").groupBy("point").agg(F.min("fp").alias("b"), F.count("*").alias("n"))
    stars = points.join(least, "point").where(F.col("fp") != F.col("b"))
    stars = stars.select(F.greatest("fp", "b").alias("a"), F.least("fp", "b").alias("b"))
    return pairs.unionByName(stars).distinct()


def components(edges: DataFrame) -> DataFrame:
    """Connected components of edges (a, b): columns ``node``, ``root`` (the smallest node), for linked nodes only.

    Alternates large-star and small-star steps; each step is a group minimum (combined
    before the shuffle) joined back, written to the shared folder.
    """
    edges = stored(edges, "edges")
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where(F.col("b") > F.col("a")).join(least, "a").where(F.col("b") != F.col("m"))
        large = large.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.where(F.col("a") != F.col("m")).select("a", F.col("m").alias("b"))).distinct()
        large = stored(large, "large_star")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = stored(small.unionByName(least.select("a", F.col("m").alias("b"))).distinct(), "small_star")
        now = edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))")).first()
        if now == state:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        state = now


def cluster(prints: DataFrame, doc_id: str = "doc_id", max_bits: int = MAX_BITS, segments: int = SEGMENTS,
            bucket: int = BUCKET) -> DataFrame:
    """``component_id`` (smallest id reachable) and ``root`` for each fingerprint ``fp`` of a written table of prints."""
    ids = stored(prints.groupBy("fp").agg(F.min(doc_id).alias("least_id")), "prints")
    linked = components(near_pairs(ids.select("fp"), max_bits, segments, bucket))
    of = ids.join(linked, ids["fp"] == linked["node"], "left").select("fp", "least_id", F.coalesce("root", "fp").alias("root"))
    of = stored(of, "roots")
    least = stored(of.groupBy("root").agg(F.min("least_id").alias("component_id")), "components")
    return stored(of.join(least, "root").select("fp", "root", "component_id"), "clusters")  # what it meets is split if a group is large


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                    max_bits: int = MAX_BITS) -> DataFrame:
    """One row per document: doc_id, ``fingerprint`` (16 hex digits), ``component_id``."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("_text"))
    prints = stored(with_fingerprint(rows, "_text", shingle).select("doc_id", "fp"), "fingerprints")
    out = prints.join(cluster(prints, "doc_id", max_bits), "fp")
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_per_group(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                  max_bits: int = MAX_BITS) -> DataFrame:
    """The documents (all columns) with one row left of each component: smallest id, then text hash, then place."""
    rows = docs.select(F.struct("*").alias("doc"), F.col(doc_id).alias("id"), F.col(text).alias("_text"))
    rows = with_fingerprint(rows, "_text", shingle).select("doc", "id", "fp", F.xxhash64("_text").alias("h"),
                                                           F.monotonically_increasing_id().alias("row"))
    rows = stored(rows, "fingerprinted")
    of = cluster(rows.select("id", "fp"), "id", max_bits).select("fp", "root")
    first = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "h", "row"))
    chosen = rows.select("id", "fp", "h", "row").join(of, "fp").groupBy("root").agg(first.alias("first"))
    chosen = stored(chosen.select(F.col("first.row").alias("row")), "chosen")
    # most rows are chosen, so the list grows with the table: merge at every size, never a broadcast
    return rows.join(chosen.hint("merge"), "row", "left_semi").select("doc.*")
