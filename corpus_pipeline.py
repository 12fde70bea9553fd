"""A corpus pipeline: each stage calls one operator on what its predecessor kept.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns a
DataFrame.  All stages but the last return the columns of ``documents``; the last adds the
shard and slot of each document.  Results between stages are written as Parquet and reread.

Every stage takes what its operator takes: nulls in any column, empty and very long texts, ties and
repeated rows, and columns of any other name pass through; an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from astroframe.functions.columns import fresh_name
from astroframe.llm import decontam, mixing, quality, sharding, simhash
from astroframe.llm.common import stored
from astroframe.llm.queries import SHARDS
from astroframe.sources.tables import table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail their own rules, or whose host is rejected, go."""
    return quality.keep_good(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints stays."""
    return simhash.one_per_group(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item, also with other names or numbers, go."""
    return decontam.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as its source's target asks for: none, one or several rows."""
    return mixing.repeated(docs)


def shard_assignment(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their shard and their slot in it, in a struct ``place`` (``place_`` where documents have such a column)."""
    out = sharding.shard_documents(docs, SHARDS)
    return out.select("doc.*", F.struct("size", "text_crc32", "shard", "slot").alias(fresh_name(docs, "place")))


STAGES = [
    ("quality rules", quality_rules),
    ("simhash near-dedup", simhash_near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("source mixing", source_mixing),
    ("sharding", shard_assignment),
]

#: the fingerprints (XXH64) and the ring have no SQL form; tests hold run() against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
