"""ETL queries: the whole chain and its one aggregation."""

from __future__ import annotations

from astroframe.constants import FEATURES_ENGINEERED, NUMERIC_COLUMNS
from astroframe.operators.aggregate import count_by
from astroframe.operators.features import etl_full
from astroframe.plans.registry import query
from astroframe.sources.fixtures import bodies

PROCESSED_DOUBLES = (*NUMERIC_COLUMNS, *FEATURES_ENGINEERED)


def processed(spark, sf):
    return etl_full(bodies(spark, sf))


@query("etl_full", "SELECT * FROM processed", views=["processed"], round_cols=PROCESSED_DOUBLES)
def q_etl_full(spark, sf):
    return processed(spark, sf)


@query("count_by_type",
       "SELECT object_type, count(*) AS count FROM processed GROUP BY object_type",
       views=["processed"])
def q_count_by_type(spark, sf):
    return count_by(processed(spark, sf), "object_type")
