"""Line dedup over levelled sorted runs (DataFrame functions only).

Method: the documents' lines arrive in batches.  A batch's line hashes are counted, merge-
anti-joined with the runs of lines already known to be frequent, and added as a sorted run of
level 0.  When a level holds ``fanout`` runs they are compacted into one run of the next level;
lines that reach the document threshold move to the frequent runs on the way.  Runs are tables
bucketed and sorted by line hash, so merging them needs no exchange of the runs.

Defined cases: a null or empty text is one empty line; lines that are empty after stripping
are never dropped; a line counts once per row, however often the row repeats it; equal rows are
separate documents; an empty table gives an empty result.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from astroframe.llm.common import SPACE, content_key, scratch_path, shuffle_parts, stored

MIN_DOCS = 10
BATCHES = 4
FANOUT = 2
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def text_lines(text: str | Column) -> Column:
    return F.split(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")), "\n")


def ascii_lower(col: Column) -> Column:
    """Lower-cases A-Z only; ASCII texts take the cheaper built-in."""
    return F.when(F.octet_length(col) == F.length(col), F.lower(col)).otherwise(F.translate(col, UPPER, UPPER.lower()))


def line_table(docs: DataFrame, text: str, keys: list[str], batches: int) -> DataFrame:
    """One row per line with a non-empty key: row key, ``pos``, line hash ``h1``/``h2``, ``first``, ``batch``.

    ``first`` marks the first of equal lines within the row, so that counting rows where it is
    set counts documents.
    """
    hashed = F.transform(F.transform(text_lines(ascii_lower(F.coalesce(F.col(text), F.lit("")))),
                                     lambda x: F.btrim(x, F.lit(SPACE))),
                         lambda x, i: F.struct(F.xxhash64(x).alias("h1"), F.xxhash64(F.lit("line"), x).alias("h2"),
                                               i.alias("pos"), (F.length(x) > 0).alias("full")))
    rows = docs.select(*keys, F.sort_array(F.filter(hashed, lambda e: e["full"])).alias("_l"))

    def entry(e: Column, j: Column) -> Column:
        before = F.get(F.col("_l"), j - 1)
        same = F.coalesce((before["h1"] == e["h1"]) & (before["h2"] == e["h2"]), F.lit(False))
        return F.struct(e["h1"].alias("h1"), e["h2"].alias("h2"), e["pos"].alias("pos"), (~same).alias("first"))

    out = rows.select(*keys, F.explode(F.transform("_l", entry)).alias("e")).select(*keys, "e.*")
    return out.withColumn("batch", F.pmod(F.col(keys[0]), F.lit(batches)).cast("int"))


class LineRuns:
    """Levelled sorted runs of (line hash, documents) with merge-anti-joins and periodic compaction."""

    def __init__(self, spark: SparkSession, min_docs: int = MIN_DOCS, fanout: int = FANOUT, buckets: int | None = None):
        self.spark, self.min_docs, self.fanout = spark, min_docs, fanout
        self.buckets = buckets or shuffle_parts(spark)
        self.levels: list[list[DataFrame]] = [[]]
        self.frequent_runs: list[DataFrame] = []

    def _run(self, counts: DataFrame) -> DataFrame:
        """Write one run (dealt by hash already): bucketed and sorted by hash below the shared checkpoint folder."""
        name, path = f"line_run_{uuid.uuid4().hex}", scratch_path(self.spark, "run")
        (counts.select("h1", "h2", "n").write.bucketBy(self.buckets, "h1", "h2")
         .sortBy("h1", "h2").option("path", path).saveAsTable(name))
        run = self.spark.table(name)
        self.spark.sql(f"DROP TABLE {name}")  # the name only; the run's files and its layout stay known to the plan
        return run

    def add(self, lines: DataFrame) -> None:
        """Add one batch: rows (h1, h2), one for each line of each document.

        Counts are combined before they are dealt by hash, so a line that most documents
        share travels as one row for each task; the merge joins then read the runs as they lie.
        """
        fresh = lines.groupBy("h1", "h2").agg(F.count("*").alias("n"))
        for run in self.frequent_runs:  # an outer join: the optimizer would move an anti join below the counting
            known = run.select("h1", "h2", F.lit(True).alias("known")).hint("merge")
            fresh = fresh.join(known, ["h1", "h2"], "left").where(F.col("known").isNull()).drop("known")
        self.levels[0].append(self._run(fresh))
        level = 0
        while len(self.levels[level]) >= self.fanout:
            self.compact(level)
            level += 1

    def compact(self, level: int) -> None:
        """Merge the runs of a level into one run of the next; frequent lines leave for their own run."""
        if level + 1 == len(self.levels):
            self.levels.append([])
        merged = self._run(self._summed(self.levels[level]))
        self.frequent_runs.append(self._run(merged.where(F.col("n") >= self.min_docs)))
        self.levels[level] = []
        self.levels[level + 1].append(merged.where(F.col("n") < self.min_docs))

    def _summed(self, runs: list[DataFrame]) -> DataFrame:
        both = runs[0]
        for run in runs[1:]:
            both = both.unionByName(run)
        return both.groupBy("h1", "h2").agg(F.sum("n").alias("n"))

    def frequent(self) -> DataFrame:
        """All line hashes found in at least ``min_docs`` documents so far (each once)."""
        rest = [run for level in self.levels for run in level]
        out = [run.select("h1", "h2") for run in self.frequent_runs]
        if rest:
            out.append(self._summed(rest).where(F.col("n") >= self.min_docs).select("h1", "h2"))
        both = out[0]
        for run in out[1:]:
            both = both.unionByName(run)
        return both.distinct()


def dedup_lines(docs: DataFrame, text: str = "text", carry: list[str] | None = None, doc_id: str = "doc_id",
                min_docs: int = MIN_DOCS, batches: int = BATCHES, fanout: int = FANOUT) -> DataFrame:
    """One row per document: ``doc`` (carried columns), ``n_lines``, ``n_dropped``, ``kept_text``.

    Lines whose key occurs in at least ``min_docs`` documents are dropped everywhere.  Only
    hashes travel through the counting; the texts are joined once with the places to drop.
    """
    spark = docs.sparkSession
    cols = docs.columns if carry is None else carry
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in cols]).alias("doc"), F.col(text).alias("_text"),
                        *content_key(doc_id, text))
    lines = line_table(keyed, "_text", ["k1", "k2"], batches)
    path = scratch_path(spark, "lines")
    lines.write.partitionBy("batch").parquet(path)
    lines = spark.read.schema(lines.schema).parquet(path)

    runs = LineRuns(spark, min_docs, fanout)
    for b in range(batches):
        runs.add(lines.where((F.col("batch") == b) & F.col("first")).select("h1", "h2"))
    frequent = stored(runs.frequent(), "frequent")

    places = (lines.join(frequent, ["h1", "h2"], "left_semi")
              .groupBy("k1", "k2").agg(F.collect_set("pos").alias("_drop")))
    places = stored(places, "places")
    out = keyed.join(places, ["k1", "k2"], "left").select(
        "doc", text_lines("_text").alias("_lines"), F.coalesce("_drop", F.array().cast("array<int>")).alias("_drop"))
    # the places that stay come from one hash set a row, so a text of many lines costs no more than their number
    stay = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("_drop"))
    kept = F.when(F.size("_drop") == 0, F.col("_lines")).otherwise(F.transform(stay, lambda i: F.get("_lines", i)))
    return out.select("doc", F.size("_lines").cast("long").alias("n_lines"), F.size("_drop").cast("long").alias("n_dropped"),
                      F.array_join(kept, "\n").alias("kept_text"))
