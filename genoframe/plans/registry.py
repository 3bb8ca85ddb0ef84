"""The engine's own queries on the driver's tables, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import activity_queries, interval_queries, link_queries, peak_queries, read_queries, table_queries  # noqa: F401  they enter their queries
from .activity_queries import activity
from .book import BOOK


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, (f, _) in BOOK.items()}


def oracle_sql() -> dict[str, str]:
    """All but the iterative ones: mixtures, clusters, refinement and balancing are held against goldens in the tests."""
    return {name: sql for name, (_, sql) in BOOK.items() if sql}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Normalised ATAC and H3K27ac activity of every element in every context."""
    return activity(spark, sf_dir)
