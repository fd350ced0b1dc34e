"""Batch data-warehouse operators for PySpark."""

from dayfold.session import configure

__all__ = ["configure"]
