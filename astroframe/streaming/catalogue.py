"""The catalogue ETL on a stream.

``etl_full`` is stateless (projections and filters only), so the very same
function runs on a streaming DataFrame; the per-type count is a streaming
aggregate in ``complete`` output mode.  State lives in the checkpoint
location under the cluster's shared checkpoint folder, so a restarted query
resumes where it stopped.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from astroframe.operators.features import etl_full
from astroframe.session import scratch_path
from astroframe.sources.fixtures import BODIES_SQL


def orders_stream(spark: SparkSession, sf_dir: str, max_files: int = 1) -> DataFrame:
    """``orders`` parquet files of a directory as a file stream (schema taken from the batch table)."""
    schema = spark.read.parquet(f"{sf_dir.rstrip('/')}/orders.parquet").schema
    return (spark.readStream.schema(schema).option("pathGlobFilter", "orders*.parquet")
            .option("maxFilesPerTrigger", max_files).parquet(sf_dir))


def bodies_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(BODIES_SQL, orders=orders_stream(spark, sf_dir))


def stream_type_counts(spark: SparkSession, sf_dir: str, name: str = "type_counts") -> DataFrame:
    """Run the streaming ETL + type count to completion; return the result table."""
    counts = etl_full(bodies_stream(spark, sf_dir)).groupBy("object_type").agg(F.count(F.lit(1)).alias("count"))
    table = f"{name}_{uuid.uuid4().hex[:12]}"
    q = (counts.writeStream.outputMode("complete").format("memory").queryName(table)
         .option("checkpointLocation", scratch_path(spark, f"stream-{name}")).start())
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    return spark.table(table).select("object_type", "count")
