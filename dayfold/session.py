"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Results depend on the first one; the next ones let AQE split a hot join key even
# where an aggregation on the same key follows the join. AQE merges shuffle partitions to 64 MB by default, as compressed,
# which is millions of narrow rows: sorted for a join and held in the hash map of an aggregation behind it, they
# take nearly 30 times as much memory in one task. With the last, the best k per group are
# cut in the map tasks for k up to 100,000 and not only up to 1000.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8m",
    "spark.sql.optimizer.windowGroupLimitThreshold": "100000",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the operators count on."""
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def work_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder for tables written in mid-job, below ``spark.checkpoint.dir``.

    Every executor has to reach it, so only a local session may fall back to a
    temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="dayfold-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table written to the shared folder and read back.

    For a result that several branches use: it is computed once, its size is
    known to the planner, and a lost executor costs nothing but a re-read.
    """
    path = work_folder(df.sparkSession, name)
    df.write.parquet(path)
    for made in _made:
        made.append((df.sparkSession, path))
    return df.sparkSession.read.schema(df.schema).parquet(path)


# What `written` has made within each open `tidy`.
_made: list[list[tuple[SparkSession, str]]] = []


@contextmanager
def tidy() -> Iterator[None]:
    """Delete, at the end of a step that leaves its results elsewhere, the tables that :func:`written` made in mid-way."""
    made: list[tuple[SparkSession, str]] = []
    _made.append(made)
    try:
        yield
    finally:
        _made.pop()
        for spark, path in made:
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
