"""Tables kept in hash buckets of a key, of which a change rewrites only those it touches."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dayfold.sources.load import write_daily_partition

BUCKET = "bucket"


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    """The bucket of a key; NULL keys have one too."""
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


@dataclass(frozen=True)
class BucketStore:
    """A table below ``path`` with one folder per bucket of ``keys``.

    ``buckets`` stays as it was when the table was first written. Choose it so that a bucket is a few tasks' work:
    what a change costs is the buckets that hold its keys. Files of a bucket replace each other as a whole when the write
    commits; as with any folder of Parquet files, readers should not run meanwhile.
    """

    spark: SparkSession
    path: str
    schema: T.StructType
    keys: Sequence[str]
    buckets: int = 256

    def read(self, touched: Sequence[int] | None = None) -> DataFrame:
        """All rows, or those of the ``touched`` buckets, whose files alone are then read; none before the first write."""
        if not self.exists(self.path):
            return self.spark.createDataFrame([], self.schema)
        table = self.spark.read.schema(self._with_bucket()).parquet(self.path)
        if touched is not None:
            table = table.where(F.col(BUCKET).isin(list(touched)))
        return table.drop(BUCKET)

    def touched(self, changes: DataFrame) -> list[int]:
        """The buckets that hold the keys of ``changes``: at most ``buckets`` numbers."""
        found = changes.select(bucket_of(self.keys, self.buckets).alias(BUCKET)).distinct()
        return sorted(r[0] for r in found.collect())

    def replace(self, rows: DataFrame) -> None:
        """Write the buckets that ``rows`` has rows of; others stay as they are.

        Each bucket's rows are dealt by AQE over as many tasks as they fill.
        """
        marked = rows.select(*self.schema.names).withColumn(BUCKET, bucket_of(self.keys, self.buckets))
        write_daily_partition(marked, self.path, BUCKET)

    def exists(self, path: str) -> bool:
        place = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return place.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(place)

    def _with_bucket(self) -> T.StructType:
        return T.StructType([*self.schema.fields, T.StructField(BUCKET, T.IntegerType())])
