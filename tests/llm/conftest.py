import pytest
from pyspark.sql import Row, SparkSession

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make_docs(spark: SparkSession):
    """documents-shaped table from (doc_id, text[, lang[, source]]) tuples, over several partitions."""

    def make(rows, parts=3):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s0",
                 None if r[1] is None else len(r[1])) for r in rows]
        return spark.createDataFrame(full, DOCS).repartition(parts)

    return make


def rows(df) -> list[Row]:
    return df.collect()


@pytest.fixture(autouse=True, scope="module")
def nothing_cached_after(spark):
    """Tables that a module's tests cache are released at its end; later tests look at what is persisted."""
    yield
    spark.catalog.clearCache()
