"""All registered queries in one place."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from docfold.plans import change_queries, document_queries, pipeline_queries, record_queries, search_queries  # noqa: F401
from docfold.plans.registry import QUERIES  # noqa: F401


def flagship(spark: SparkSession, sf: str) -> DataFrame:
    """Change log -> documents -> the twenty live users with the highest value."""
    return search_queries.topk(spark, sf)
