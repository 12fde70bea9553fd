"""Helpers shared by the corpus operators: words, row keys, bitmaps (and the written tables and ranks they build on).

Conventions that every operator of this package follows:

* a null text is treated as stated in each docstring and never crashes;
* input columns an operator does not need are never touched; where whole rows must
  travel, they are packed into one struct so that their names cannot clash;
* intermediate tables are written below ``spark.checkpoint.dir`` and reread, so a lost
  executor costs a retry of one stage and later passes read only the columns they need.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from astroframe.operators.ordering import in_order, with_rank
from astroframe.session import scratch_path, stored

__all__ = ["SPACE", "bitmap", "content_key", "in_bitmap", "in_order", "scratch_path", "shuffle_parts", "stored", "with_rank", "words"]

#: the white space of the word contract: blank, tab, line feed, vertical tab, form feed, return
SPACE = " \t\n\x0b\x0c\r"
SPACE_CLASS = r"[\x20\x09-\x0D]+"


def words(text: str | Column) -> Column:
    """Array of the words ``[^\\x20\\x09-\\x0D]+`` of a text; null text gives an empty array."""
    col = F.col(text) if isinstance(text, str) else text
    return F.array_remove(F.split(F.coalesce(col, F.lit("")), SPACE_CLASS), "")


def content_key(*cols: str | Column) -> list[Column]:
    """Two independent 64-bit hashes (columns k1, k2) of the given columns; nulls count as a value.

    Rows that agree in all the columns get the same key, so a verdict that depends on
    these columns alone can be joined back without a row id.
    """
    parts = []
    for c in cols:
        col = F.col(c) if isinstance(c, str) else c
        parts += [col.isNull(), col]
    return [F.xxhash64(*parts).alias("k1"), F.xxhash64(F.lit("second"), *parts).alias("k2")]


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


#: bounds of the hash bitmaps that are sent to every task (64 KiB to 16 MiB)
MIN_BITS, MAX_BITS = 19, 27


def bitmap(keys: DataFrame, col: str, n: int) -> np.ndarray:
    """Bitmap of a hash column, at most 16 MiB whatever the number of keys.

    Sets bit ``hash mod 2**b``; ``b`` follows the key count ``n`` up to ``MAX_BITS``.  A
    membership test on it has no false negatives; false positives are for the caller's
    join to drop.  Words of 63 bits are folded together in Spark, so the driver gathers
    the bitmap itself and never the keys.
    """
    bits = min(MAX_BITS, max(MIN_BITS, int(n * 16).bit_length()))
    place = F.col(col).bitwiseAND(F.lit((1 << bits) - 1))
    folded = (keys.select(F.shiftright(place, 5).alias("word"),
                          F.call_function("shiftleft", F.lit(1).cast("long"), place.bitwiseAND(F.lit(31)).cast("int")).alias("bit"))
              .groupBy("word").agg(F.bit_or("bit").alias("bits")))
    out = np.zeros(1 << (bits - 5), dtype=np.uint32)
    for row in folded.toLocalIterator():
        out[row["word"]] = row["bits"]
    return out


def in_bitmap(bm: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Boolean array: is each uint64 hash possibly one of the bitmap's keys?"""
    place = hashes & np.uint64(len(bm) * 32 - 1)
    word = bm[(place >> np.uint64(5)).astype(np.int64)]
    return (word >> (place & np.uint64(31)).astype(np.uint32)) & np.uint32(1) != 0
