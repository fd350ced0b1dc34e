"""The query catalogue."""

from dayfold.catalog import clean, dims, facts, load, metrics, quality, summaries  # noqa: F401
from dayfold.catalog.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
