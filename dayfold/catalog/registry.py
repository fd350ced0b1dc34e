"""Named queries on the source tables, each with equivalent SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dayfold.session import configure
from dayfold.sources.tables import read_table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


class Tables:
    """The source tables of one folder as attributes."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = configure(spark)
        self.folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        return read_table(self.spark, self.folder, name)


def plain(df: DataFrame) -> DataFrame:
    """Types that look the same from any engine: text, bigint, double, boolean."""
    columns = []
    for f in df.schema.fields:
        col = F.col(f.name)
        if isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            col = col.cast("string")
        elif isinstance(f.dataType, T.DecimalType):
            col = col.cast("double")
        elif isinstance(f.dataType, T.IntegralType):
            col = col.cast("bigint")
        elif isinstance(f.dataType, T.ArrayType):
            col = F.concat_ws(",", col)
        columns.append(col.alias(f.name))
    return df.select(columns)


def query(name: str, sql: str | None = None) -> Callable[[Callable[[Tables], DataFrame]], Query]:
    """Register a function of the tables as a query of (session, folder)."""

    def register(fn: Callable[[Tables], DataFrame]) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return plain(fn(Tables(spark, folder)))

        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return run

    return register
