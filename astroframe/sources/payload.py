"""Positional payloads, ``{"fields": [names], "data": [[values], ...]}``, read by many tasks however large one document is.

A JSON document has no line structure to split at, and a bracket inside a string ends no row.  The text source cuts the
file at every ``]`` and deals byte ranges to tasks.  Whether a piece starts inside a string is the parity of all quotes before
it: each task counts its own quotes, and a table with one row per byte range carries parity and row number over
to the next.  With both known, a piece whose ``]`` lies outside strings ends an array; nearly every array is one piece and
goes on where it is, and only arrays cut by a bracket in a string, or by the end of a byte range, are put together in a shuffle.

Defined cases: any white space between tokens and any order of the keys; other keys are skipped; a requested column that
``fields`` lacks is NULL, as is a short row's missing value; JSON null is NULL and numbers are kept as text; a document without
``data``, or with none in it, has no rows; several documents may lie under the path, one a file, each with its own ``fields``.
Values are scalars; a value that is an array is not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from astroframe.session import checkpoint_dir, stored

HEADER = r'"fields"\s*:\s*\['
FIRST = r'"data"\s*:\s*\['
#: rows of a range of the key that one task sorts before a document is written
RANGE_ROWS = 200_000


def quotes(text: Column) -> Column:
    """Number of quotes that open or close a string."""
    plain = F.regexp_replace(text, r"\\.", "")
    return F.length(plain) - F.length(F.translate(plain, '"', ""))


def pieces(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, idx, text, odd): the text between closing brackets, with the parity of quotes in it."""
    cut = spark.read.option("lineSep", "]").text(path)
    cut = cut.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").alias("text"))
    return cut.withColumns({"idx": F.monotonically_increasing_id(), "odd": (quotes(F.col("text")) % 2).cast("int")})


def arrays(spark: SparkSession, path: str) -> DataFrame:
    """(file, array, text): every innermost array of the documents in order, with the text since the one before."""
    run = Window.partitionBy("file", "block").orderBy("idx").rowsBetween(Window.unboundedPreceding, 0)
    cut = stored(pieces(spark, path), "payload_pieces").withColumn("inside", F.sum("odd").over(run) % 2)
    blocks = cut.groupBy("file", "block").agg((F.sum("odd") % 2).cast("int").alias("odd"), F.count_if(F.col("inside") == 0).alias("ends0"),
                                              F.count_if(F.col("inside") == 1).alias("ends1"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("start", F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2)
    blocks = blocks.withColumn("own", F.when(F.col("start") == 0, F.col("ends0")).otherwise(F.col("ends1")))
    blocks = stored(blocks.select("file", "block", "start", F.coalesce(F.sum("own").over(before), F.lit(0)).alias("base")), "payload_blocks")
    placed = cut.join(blocks, ["file", "block"]).withColumn("ends", (F.col("inside") == F.col("start")).cast("int"))
    order = Window.partitionBy("file", "block").orderBy("idx")
    placed = placed.withColumns({"array": F.col("base") + F.sum("ends").over(run) - F.col("ends"), "prior": F.lag("ends").over(order)})
    placed = stored(placed.withColumn("alone", (F.col("ends") == 1) & F.coalesce(F.col("prior") == 1, F.lit(False)))
                    .select("file", "block", "idx", "array", "text", "alone"), "payload_arrays")
    parts = placed.where(~F.col("alone")).groupBy("file", "array").agg(F.sort_array(F.collect_list(F.struct("block", "idx", "text"))).alias("parts"))
    whole = parts.select("file", "array", F.array_join(F.transform("parts", lambda p: p["text"]), "]").alias("text"))
    return placed.where("alone").select("file", "array", "text").unionByName(whole)


def read_positional_payload(spark: SparkSession, path: str, out_cols: list[str]) -> DataFrame:
    """One row per data row of the documents under ``path``, the named columns as text."""
    found = arrays(spark, path)
    marks = found.where(F.col("text").rlike(HEADER) | F.col("text").rlike(FIRST) | F.col("text").rlike(r"^\s*$"))
    names = F.when(F.col("text").rlike(HEADER), F.from_json(F.concat(F.regexp_replace("text", rf"(?s)^.*{HEADER}", "["), F.lit("]")), "array<string>"))
    first = F.when(F.col("text").rlike(FIRST + r"\s*\["), F.col("array"))  # else there is no row
    marks = stored(marks.select("file", "array", names.alias("names"), first.alias("first")), "payload_marks")
    heads = marks.groupBy("file").agg(F.max("names").alias("names"), F.min("first").alias("first"))
    last = marks.join(heads.select("file", F.col("first").alias("begin")), "file").where((F.col("array") > F.col("begin")) & F.col("names").isNull() & F.col("first").isNull())
    heads = heads.join(last.groupBy("file").agg(F.min("array").alias("last")), "file", "left")
    heads = stored(heads.where(F.col("names").isNotNull() & F.col("first").isNotNull()), "payload_heads")
    rows = found.join(heads, "file").where((F.col("array") >= F.col("first")) & ((F.col("array") < F.col("last")) | F.col("last").isNull()))
    inner = F.regexp_replace(F.when(F.col("array") == F.col("first"), F.regexp_replace("text", rf"(?s)^.*{FIRST}", "")).otherwise(F.col("text")), r"^\s*,?\s*", "")
    rows = rows.select("names", F.from_json(F.concat(inner, F.lit("]")), "array<string>").alias("values"), inner.alias("inner"))
    rows = rows.where(F.col("inner").startswith("["))
    return rows.select(*[F.try_element_at("values", F.nullif(F.array_position("names", F.lit(c)).cast("int"), F.lit(0))).alias(c) for c in out_cols])


def in_ranges(rows: DataFrame, n: int, *keys: str) -> DataFrame:
    """The ``n`` rows sorted by the keys, written to the checkpoint folder in ranges of about ``RANGE_ROWS`` rows, a task each."""
    checkpoint_dir(rows.sparkSession)
    return rows.repartitionByRange(-(-n // RANGE_ROWS), *keys).sortWithinPartitions(*keys).checkpoint(eager=True)


def write_positional_payload(df: DataFrame, path: str, cols: list[str], key: str) -> None:
    """The rows as one document in one file, in the order of ``key``.

    One task writes it, line by line: it takes the sorted ranges one after the other, the one with the head first, and sorts nothing.
    """
    first, n = df.agg(F.min(key), F.count(F.lit(1))).first()
    values = F.to_json(F.array(*[F.col(c).cast("string") for c in cols]))
    rows = df.select(F.lit(1).alias("part"), F.col(key).alias("key"), F.concat(F.when(F.col(key) == F.lit(first), "").otherwise(","), values).alias("value"))
    spark = df.sparkSession
    head = '{"fields": [' + ", ".join(f'"{c}"' for c in cols) + '], "data": ['
    ends = spark.createDataFrame([(0, head), (2, "]}")], "part int, value string").select("part", F.lit(None).cast(rows.schema["key"].dataType).alias("key"), "value")
    in_ranges(rows.unionByName(ends), n + 2, "part", "key").select("value").coalesce(1).write.mode("overwrite").text(path)
