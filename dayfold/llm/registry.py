"""Named queries of this subpackage, each with equivalent SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from dayfold.llm.tables import read
from dayfold.session import configure

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


class Tables:
    """The text tables of one folder as attributes."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = configure(spark)
        self.folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        return read(self.spark, self.folder, name)


def query(name: str, sql: str | None = None) -> Callable[[Callable[[Tables], DataFrame]], Query]:
    """Register a function of the tables as a query of (session, folder)."""

    def register(fn: Callable[[Tables], DataFrame]) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(Tables(spark, folder))

        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return run

    return register
