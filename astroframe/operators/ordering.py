"""Global order without a global task: range-partitioned, sorted rows and their ranks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def shuffle_parts(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def in_order(df: DataFrame, *order: str | Column, parts: int | None = None) -> DataFrame:
    """Rows range-partitioned and sorted by ``order``, with ``part`` and ``idx`` (place in the partition).

    Equal sort keys stay in one partition, so end ``order`` with a column that tells rows
    apart where a value may hold many rows (an id, or a row number of the scan).  Write the
    result (``session.stored``) before using ``part`` and ``idx``: they fix the slices.
    """
    place = F.monotonically_increasing_id()
    return (df.repartitionByRange(parts or shuffle_parts(df), *order).sortWithinPartitions(*order)
            .withColumns({"part": F.shiftright(place, 33).cast("int"),
                          "idx": place.bitwiseAND(F.lit((1 << 33) - 1))}))


def part_starts(placed: DataFrame) -> list[tuple[int, int, int]]:
    """(part, first rank, rows) of the partitions of a written ``in_order`` result; bounded by their number."""
    out, total = [], 0
    for part, n in sorted((r["part"], r["n"]) for r in placed.groupBy("part").agg(F.count("*").alias("n")).collect()):
        out.append((part, total, n))
        total += n
    return out


def with_rank(placed: DataFrame, starts: list[tuple[int, int, int]] | None = None) -> DataFrame:
    """Replaces ``part`` and ``idx`` by the gapless global ``rank`` (from 0)."""
    base = [(part, first) for part, first, _ in (part_starts(placed) if starts is None else starts)]
    offsets = placed.sparkSession.createDataFrame(base, "part int, base long")
    return (placed.join(F.broadcast(offsets), "part")
            .withColumn("rank", F.col("base") + F.col("idx")).drop("base", "part", "idx"))
