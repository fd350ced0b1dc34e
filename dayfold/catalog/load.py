"""Loading: increments, daily partitions, JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayfold.catalog.registry import Tables, query
from dayfold.functions.columns import day_of, money
from dayfold.session import work_folder
from dayfold.sources.load import load_increment, parse_json_column, write_daily_partition


@query(
    "load_increment",
    """
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
           CAST(o_orderdate AS VARCHAR) AS o_orderdate, o_orderpriority
    FROM orders
    WHERE o_orderdate >= TIMESTAMP '1998-03-01' AND o_orderdate < TIMESTAMP '1998-04-01'
    """,
)
def increment(t: Tables) -> DataFrame:
    return load_increment(t.orders, "o_orderdate", "1998-03-01", "1998-04-01")


@query(
    "write_daily_partition",
    """
    SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS dt, count(*) AS n,
           CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total
    FROM events GROUP BY CAST(ts AS DATE)
    """,
)
def daily_partitions(t: Tables) -> DataFrame:
    """Write all days, rewrite some of them, read back."""
    path = work_folder(t.spark, "events-by-day")
    events = t.events.withColumn("dt", day_of("ts"))
    write_daily_partition(events, path)
    write_daily_partition(load_increment(events, "ts", "2024-01-10", "2024-01-13"), path)
    back = t.spark.read.schema(events.schema).parquet(path)
    return back.groupBy("dt").agg(F.count(F.lit(1)).alias("n"), F.sum(money("value")).alias("total"))


@query(
    "parse_json_column",
    """
    SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, NOT json_valid(props) AS is_malformed
    FROM events
    """,
)
def json_props(t: Tables) -> DataFrame:
    return parse_json_column(t.events, "props", "k int").select("event_id", "k", "is_malformed")
