"""Schemas and reads of the text tables, and tables written in mid-job."""

from __future__ import annotations

import math
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dayfold.session import work_folder

SCHEMAS = {
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
    "labels": "doc_id bigint, quality int, toxic int",
}


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One table of ``folder``; only the columns that are used reach the scan."""
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


# Rows of a file of a table that is known to be short. Only narrow tables are written so.
FILE_ROWS = 1 << 14


class Scratch:
    """Tables that an operator writes to the shared folder while it runs.

    A written table is computed once, has a size the planner knows, and survives
    the loss of any executor. ``drop`` deletes one that later tables replace.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.base = work_folder(spark, name)
        self.made = 0

    def write(self, df: DataFrame, most: int | None = None) -> DataFrame:
        """``df`` as a table; of at most ``most`` rows, if that is known, so that a short one is not cut into very many files."""
        if most is not None:
            df = df.coalesce(max(1, math.ceil(most / FILE_ROWS)))
        self.made += 1
        path = f"{self.base}/{self.made}"
        df.write.option("compression", "zstd").parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch_path = path
        return out

    def drop(self, *tables: DataFrame) -> None:
        for table in tables:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(table._scratch_path)
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def known_text(col: str) -> Column:
    """The text, with NULL as empty."""
    return F.coalesce(F.col(col), F.lit(""))


def need(df: DataFrame, columns: Iterable[str]) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; there are {df.columns}")
