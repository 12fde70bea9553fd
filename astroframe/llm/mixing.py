"""Mixing sources to target weights: capped water-filling and seeded repetitions.

Method: every source asks for its weight's share of the total.  Sources whose share exceeds
``max_epochs`` times their size are clamped there and the excess is shared again by weight,
until no source is above.  A source is then repeated a whole number of times, plus a seeded
fraction: documents in hash order until the rest of the target is met (to half a document).

Defined cases: a null text has size 0; a null source is a source of its own (the last); equal
rows have equal hashes and are told apart by their place in the scan; documents of size 0 take
0 words; an empty table gives an empty result; other columns travel packed in one struct.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from astroframe.llm.common import in_order, stored, with_rank, words

MAX_EPOCHS = 3
WEIGHTS = (1, 2, 3)
SEED = 17


def mix_key(doc_id: str, text: str, seed: int) -> Column:
    """60-bit seeded hash of a document; md5, so that SQL can repeat it."""
    parts = [F.lit(str(seed)), F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.md5(F.coalesce(F.col(text), F.lit("")))]
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 15), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Water-filled targets per source: columns source, source_size, target.

    ``sizes`` has one row per source (source, source_size).  Each round is one aggregate
    over the sources and ends when no further source is clamped; shares are kept as exact
    integers until the final division.
    """
    ranked = with_rank(stored(in_order(sizes, F.col("source").isNull(), "source"), "sources"))
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    src = stored(ranked.select("source", "source_size", weight.alias("w")), "weights")
    exact = "decimal(38,0)"
    totals = src.agg(F.sum(F.col("source_size").cast(exact)).alias("t"), F.sum("w").alias("w")).first()
    total, all_w = int(totals["t"] or 0), int(totals["w"] or 0)
    rest, rest_w, clamped = total, all_w, 0
    while True:
        share = Fraction(rest, rest_w) if rest_w else Fraction(0)
        num, den = share.numerator, share.denominator
        above = (F.col("w") * F.lit(num).cast(exact) > F.col("source_size").cast(exact) * F.lit(max_epochs * den).cast(exact))
        if not rest_w:
            break
        now = src.where(above).agg(F.count("*").alias("n"), F.sum(F.col("source_size").cast(exact)).alias("t"),
                                   F.sum("w").alias("w")).first()
        if now["n"] == clamped:
            break
        clamped, rest, rest_w = now["n"], total - max_epochs * int(now["t"]), all_w - int(now["w"])
    even = (F.col("w") * F.lit(rest).cast(exact)).cast("double") / F.lit(float(max(1, rest_w)))
    target = F.when(above, F.col("source_size").cast("double") * max_epochs).otherwise(even)
    return src.select("source", "source_size", target.alias("target"))


def mix(docs: DataFrame, text: str = "text", source: str = "source", doc_id: str = "doc_id", carry: list[str] | None = None,
        weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: int = SEED) -> DataFrame:
    """One row per document: ``doc`` (carried columns), ``size``, ``source_size``, ``target``, ``copies``, ``taken``.

    Only (source, size, hash) rows are shuffled: they are ranged by source and hash, so a
    source with a third of all rows is spread over a third of the tasks.  What comes back is
    one cut point per source, which each document compares with its own hash.  Equal rows
    that lie across a cut are written and ranked, to take just as many of them as it asks for.
    """
    cols = docs.columns if carry is None else carry
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in cols]).alias("doc"), F.col(source).alias("source"),
                       F.size(words(text)).cast("long").alias("size"), mix_key(doc_id, text, seed).alias("h"))
    keys = stored(rows.drop("doc").withColumn("row", F.monotonically_increasing_id()), "mix_keys")
    sizes = keys.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = source_targets(sizes, weights, max_epochs)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    targets = targets.withColumn("whole", whole.cast("long"))
    targets = stored(targets.withColumn("want", F.col("target") - F.col("whole") * F.col("source_size")), "targets")

    placed = stored(in_order(keys, F.col("source").isNull(), "source", "h", "row"), "mix_order")
    part_source = Window.partitionBy("part", "source").orderBy("idx").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("size").over(part_source), F.lit(0))
    parts = placed.groupBy("part", "source").agg(F.sum("size").alias("n"))
    earlier = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(F.col("part").alias("p"), F.col("source").alias("s"),
                         F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    run = placed.withColumn("before", before)
    run = run.join(stored(parts, "mix_parts"), (F.col("part") == F.col("p")) & F.col("source").eqNullSafe(F.col("s"))).drop("p", "s")
    want = targets.select(F.col("source").alias("s"), "want")
    run = run.join(want, F.col("source").eqNullSafe(F.col("s")))
    run = run.withColumn("in", 2 * (F.col("before") + F.col("base")) + F.col("size") <= 2 * F.col("want")).select("source", "h", "in")
    cuts = run.groupBy(F.col("source").alias("s")).agg(F.max(F.when(F.col("in"), F.col("h"))).alias("last"),
                                                      F.min(F.when(~F.col("in"), F.col("h"))).alias("out"))
    cuts = targets.join(cuts, F.col("source").eqNullSafe(F.col("s"))).withColumn(
        "tied", F.coalesce(F.col("last") == F.col("out"), F.lit(False)))
    cuts = stored(cuts.select(F.col("source").alias("of"), "source_size", "target", "whole", "last", "tied"), "mix_cuts")

    out = rows.join(cuts, F.col("source").eqNullSafe(F.col("of")))
    cut_row = F.coalesce(F.col("tied") & (F.col("h") == F.col("last")), F.lit(False))
    result = out.where(~cut_row).withColumn("extra", F.coalesce(F.col("h") <= F.col("last"), F.lit(False)).cast("int"))
    if not cuts.where("tied").isEmpty():
        equal = stored(in_order(out.where(cut_row).withColumn("row", F.monotonically_increasing_id()), "source", "row"), "mix_equal")
        ranked = with_rank(equal)
        first = ranked.groupBy(F.col("of").alias("s")).agg(F.min("rank").alias("first"))
        take = run.join(cuts.where("tied"), F.col("source").eqNullSafe(F.col("of"))).where(F.col("in") & (F.col("h") == F.col("last")))
        take = take.groupBy(F.col("of").alias("t")).agg(F.count("*").alias("take"))
        bounds = stored(first.join(take, F.col("s").eqNullSafe(F.col("t"))).drop("t"), "mix_ties")
        ranked = ranked.join(bounds, F.col("of").eqNullSafe(F.col("s")))
        extra = (F.col("rank") - F.col("first") < F.col("take")).cast("int")
        result = result.unionByName(ranked.withColumn("extra", extra).select(*result.columns))
    result = result.withColumn("copies", F.least(F.col("whole") + F.col("extra"), F.lit(max_epochs)))
    return result.select("doc", "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken"))


def repeated(docs: DataFrame) -> DataFrame:
    """The mixed corpus itself: every document as often as the mix takes it (left out at 0)."""
    out = mix(docs).where(F.col("copies") > 0)
    return out.select("doc", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("doc.*")
