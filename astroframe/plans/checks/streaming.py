"""Streaming form of the type count (same oracle as the batch query)."""

from __future__ import annotations

from astroframe.plans.registry import query
from astroframe.streaming.catalogue import stream_type_counts


@query("stream_count_by_type",
       "SELECT object_type, count(*) AS count FROM processed GROUP BY object_type", views=["processed"])
def q_stream_count_by_type(spark, sf):
    return stream_type_counts(spark, sf)
