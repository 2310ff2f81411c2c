"""All queries of the engine's operators, by name, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .plans import convert, files, filters, measures, more, relations, reviews, text
from .plans.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "convert", "files", "filters", "flagship", "measures", "more", "relations", "reviews", "text"]


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of repeated paragraphs: digits masked, in two documents or more."""
    return QUERIES["agg4_groups"](spark, sf_dir)
