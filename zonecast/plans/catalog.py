"""All registered queries: name -> (Spark query, comparison SQL or None)."""

from __future__ import annotations

from zonecast.plans import (
    features_queries,
    forecast_queries,
    forest_queries,
    ingest_queries,
    marts_queries,
    report_queries,
    stream_queries,
    value_queries,
)

CATALOG = {
    **marts_queries.QUERIES,
    **ingest_queries.QUERIES,
    **features_queries.QUERIES,
    **forecast_queries.QUERIES,
    **value_queries.QUERIES,
    **report_queries.QUERIES,
    **stream_queries.QUERIES,
    **forest_queries.QUERIES,
}
