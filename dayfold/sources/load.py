"""Increments in, daily partitions out."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def load_increment(df: DataFrame, ts_col: str, start: Any, end: Any) -> DataFrame:
    """Rows with ``start <= ts_col < end``.

    The bounds are cast to the column's type and not the other way round, so
    the filter reaches the Parquet scan, or prunes partitions on a day column.
    """
    dtype = df.schema[ts_col].dataType
    ts = F.col(ts_col)
    return df.where((ts >= F.lit(start).cast(dtype)) & (ts < F.lit(end).cast(dtype)))


def write_daily_partition(df: DataFrame, path: str, dt_col: str = "dt") -> None:
    """Replace the days that are present in ``df`` and leave all others alone.

    The rebalance hint gathers each day into few files; AQE cuts a large day
    over several tasks, so no day has to fit into one.
    """
    (
        df.hint("rebalance", F.col(dt_col))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(dt_col)
        .parquet(path)
    )


def write_day(df: DataFrame, path: str, day: date, dt_col: str = "dt", within: Sequence[str] = ()) -> None:
    """Replace one day, also when ``df`` has no rows; ``df`` holds that day alone.

    With ``within`` the day has a folder for each value of these columns.
    """
    rows = df.drop(dt_col)
    if within:
        rows = rows.hint("rebalance", *[F.col(c) for c in within])
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "static")
    (writer.partitionBy(*within) if within else writer).parquet(f"{path}/{dt_col}={day.isoformat()}")


def read_days(spark: SparkSession, path: str, schema: T.StructType | str, dt_col: str = "dt") -> DataFrame:
    """The table below ``path``; a filter on its day prunes whole folders."""
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    fields = [f for f in schema.fields if f.name != dt_col]
    return spark.read.schema(T.StructType([*fields, T.StructField(dt_col, T.DateType())])).parquet(path)


def parse_json_column(
    df: DataFrame, col: str, ddl: str, flag: str = "is_malformed", keep_text: bool = False
) -> DataFrame:
    """Replace JSON text by typed fields.

    Text that is not a JSON object, or a field of the wrong type, gives NULL
    there and sets ``flag``. A NULL text gives NULL fields and is not malformed.
    Text that goes on behind a complete object is no JSON object either; as Spark's parser stops
    there, it is read once more as the first of two entries of an array.
    """
    fields = T.StructType.fromDDL(ddl).fields
    parsed = F.from_json(
        F.col(col),
        T.StructType([*fields, T.StructField("__bad", T.StringType())]),
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "__bad", "allowSingleQuotes": "false"},
    )
    kept = [c for c in df.columns if keep_text or c != col]
    last = "the end"
    entries = F.from_json(
        F.concat(F.lit("["), F.col(col), F.lit(f',"{last}"]')), "array<string>", {"allowSingleQuotes": "false"}
    )
    whole = F.coalesce((F.size(entries) == 2) & (F.element_at(entries, -1) == last), F.lit(False))
    # Empty text parses to a NULL struct.
    is_bad = F.col("__json").getField("__bad").isNotNull() | (F.col("__json").isNull() & F.col("__given"))
    return df.select(*kept, F.when(whole, parsed).alias("__json"), F.col(col).isNotNull().alias("__given")).select(
        *kept,
        *[F.col("__json").getField(f.name).alias(f.name) for f in fields],
        is_bad.alias(flag),
    )
