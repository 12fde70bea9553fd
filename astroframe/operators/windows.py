"""Trailing row-frame aggregates that stay balanced when one key is huge.

``Window.partitionBy(key).orderBy(t).rowsBetween(-n, 0)`` puts every row of a
key into one task; a key holding a third of the table becomes a third of the
job in one task.  Here the rows are range-partitioned on (key, order) and
written once, which cuts a hot key into contiguous slices.  Every slice gets
the n rows before it as a halo (at most slices x n rows in all), the native
window runs per (slice, key), and the halo rows are dropped again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from astroframe.operators.ordering import in_order, part_starts, with_rank
from astroframe.session import stored

AGGS = {"count": lambda c: F.count(F.lit(1)), "sum": F.sum, "mean": F.avg, "min": F.min, "max": F.max}


def halo_pairs(starts: list[tuple[int, int, int]], n: int) -> list[tuple[int, int, int, int]]:
    """(part, slice, from rank, before rank): the rows of ``part`` that stand within n rows before ``slice``."""
    out = []
    for i, (target, first, _) in enumerate(starts):
        for part, begin, rows in reversed(starts[:i]):
            if begin + rows <= first - n:
                break
            out.append((part, target, first - n, first))
    return out


def trailing_aggregates(df: DataFrame, key: str, order: Sequence[str], value: str, n: int = 30,
                        aggs: Sequence[str] = ("count", "mean", "min"), partitions: int | None = None) -> DataFrame:
    """Per row: ``aggs`` of ``value`` over the row and the n rows before it in its key's order.

    Output: the input columns plus ``{value}_{agg}`` for each aggregate, with
    SQL's treatment of NULL values and infinities.  Exact for a total order
    (ties in ``order`` are broken by the listed columns); rows whose key or
    order columns are NULL come last, as SQL orders NULLs.
    """
    spark = df.sparkSession
    sort = [f"s{i}" for i in range(1 + len(order))]
    # the row travels in one struct, so its columns cannot clash with those of the slices
    rows = df.select(F.struct(*df.columns).alias("row"), F.col(value).alias("v"), *[F.col(c).alias(s) for s, c in zip(sort, (key, *order))])
    placed = stored(in_order(rows, *[F.col(s).asc_nulls_last() for s in sort], parts=partitions), "slices")
    starts = part_starts(placed)
    ranked = with_rank(placed.withColumn("slice", F.col("part")), starts)
    pairs = spark.createDataFrame(halo_pairs(starts, n), "slice int, target int, low long, high long")
    halo = ranked.join(F.broadcast(pairs), "slice").where((F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high")))
    halo = halo.withColumn("slice", F.col("target")).drop("target", "low", "high")
    rows = ranked.withColumn("own", F.lit(True)).unionByName(halo.withColumn("own", F.lit(False)))
    frame = Window.partitionBy("slice", "s0").orderBy("rank").rowsBetween(-n, 0)
    rows = rows.withColumns({f"a{i}": AGGS[a]("v").over(frame) for i, a in enumerate(aggs)}).where("own")
    taken = {f"{value}_{a}": F.col(f"a{i}").alias(f"{value}_{a}") for i, a in enumerate(aggs)}
    return rows.select(*[F.col("row")[c].alias(c) for c in df.columns if c not in taken], *taken.values())
