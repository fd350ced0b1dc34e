"""Cleaning and conforming."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayfold.catalog.registry import Tables, query
from dayfold.operators.clean import (
    conform_types,
    latest_by_key,
    mask_columns,
    orphan_rows,
    split_valid,
    tag_rejects,
)


@query(
    "latest_by_key",
    """
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
           CAST(o_orderdate AS VARCHAR) AS o_orderdate, o_orderpriority
    FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey
                                       ORDER BY o_orderdate DESC, o_orderkey DESC) AS nth FROM orders)
    WHERE nth = 1
    """,
)
def latest_order(t: Tables) -> DataFrame:
    return latest_by_key(t.orders, ["o_custkey"], ["o_orderdate", "o_orderkey"])


@query(
    "conform_types",
    """
    SELECT p_partkey,
           coalesce(TRY_CAST(replace(p_brand, 'Brand#', '') AS BIGINT), -1) AS brand_no,
           coalesce(TRY_CAST(p_name AS BIGINT), 0) AS name_no
    FROM part
    """,
)
def brand_numbers(t: Tables) -> DataFrame:
    """One column whose text is mostly numbers, one whose text never is."""
    raw = t.part.select(
        "p_partkey",
        F.replace("p_brand", F.lit("Brand#"), F.lit("")).alias("brand_no"),
        F.col("p_name").alias("name_no"),
    )
    return conform_types(raw, {"brand_no": ("bigint", -1), "name_no": ("bigint", 0)})


def _shipping_rules() -> dict:
    return {
        "shipped_before_order": F.col("l_shipdate") >= F.col("o_orderdate"),
        "large_discount": F.col("l_discount") <= 0.09,
    }


def _lines(t: Tables) -> DataFrame:
    return t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_discount", "o_orderdate"
    )


_LINES_SQL = """
    WITH tagged AS (
        SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey,
               concat_ws(',', CASE WHEN NOT coalesce(l_shipdate >= o_orderdate, false) THEN 'shipped_before_order' END,
                              CASE WHEN NOT coalesce(l_discount <= 0.09::DOUBLE, false) THEN 'large_discount' END)
                   AS reject_reasons
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
"""


@query(
    "split_valid",
    _LINES_SQL
    + """
    SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey, reject_reasons
    FROM tagged WHERE reject_reasons <> ''
    """,
)
def rejected_lines(t: Tables) -> DataFrame:
    _, rejected = split_valid(_lines(t), _shipping_rules())
    return rejected.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "reject_reasons")


@query("reject_counts", _LINES_SQL + "SELECT reject_reasons, count(*) AS n FROM tagged GROUP BY reject_reasons")
def reject_counts(t: Tables) -> DataFrame:
    tagged = tag_rejects(_lines(t), _shipping_rules())
    return tagged.groupBy("reject_reasons").agg(F.count(F.lit(1)).alias("n"))


@query(
    "orphan_rows",
    """
    SELECT c_custkey, c_name FROM customer
    WHERE NOT EXISTS (SELECT 1 FROM events WHERE user_id = c_custkey)
    """,
)
def customers_without_events(t: Tables) -> DataFrame:
    return orphan_rows(t.customer, t.events, {"c_custkey": "user_id"}, spread_by=["c_name"]).select(
        "c_custkey", "c_name"
    )


@query(
    "mask_columns",
    """
    SELECT c_custkey, sha256('pepper' || c_name) AS c_name,
           repeat('*', greatest(length(c_mktsegment) - 3, 0)) || right(c_mktsegment, 3) AS c_mktsegment
    FROM customer
    """,
)
def masked_customers(t: Tables) -> DataFrame:
    return mask_columns(
        t.customer.select("c_custkey", "c_name", "c_mktsegment"),
        {"c_name": "hash", "c_mktsegment": ("keep_last", 3)},
        salt="pepper",
    )
