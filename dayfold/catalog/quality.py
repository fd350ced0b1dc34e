"""Data-quality checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayfold.catalog.registry import Tables, query
from dayfold.operators.quality import (
    InRange,
    InSet,
    NotNull,
    References,
    Unique,
    profile_columns,
    reconcile,
    reconcile_digests,
    rule_audit,
    volume_drift,
)
from dayfold.operators.summaries import daily_summary

_ORDER_COLUMNS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")


@query(
    "profile_columns",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(*) AS rows, count(*) - count({c}) AS nulls,
            count(DISTINCT {c}) AS distinct_values, CAST(min({c}) AS VARCHAR) AS min_value,
            CAST(max({c}) AS VARCHAR) AS max_value FROM orders"""
        for c in _ORDER_COLUMNS
    ),
)
def order_profile(t: Tables) -> DataFrame:
    return profile_columns(t.orders)


@query(
    "rule_audit",
    """
    SELECT 'has_ship_date' AS rule, count(*) FILTER (l_shipdate IS NULL) AS failures FROM lineitem
    UNION ALL SELECT 'discount_range',
              count(*) FILTER (NOT coalesce(l_discount BETWEEN 0 AND 0.09::DOUBLE, false)) FROM lineitem
    UNION ALL SELECT 'return_flag', count(*) FILTER (NOT coalesce(l_returnflag IN ('A', 'N'), false)) FROM lineitem
    UNION ALL SELECT 'line_key', count(*)
              FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
    UNION ALL SELECT 'order_exists', count(*) FROM lineitem
              WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderstatus <> 'P')
    """,
)
def line_audit(t: Tables) -> DataFrame:
    return rule_audit(
        t.lineitem,
        {
            "has_ship_date": NotNull("l_shipdate"),
            "discount_range": InRange("l_discount", 0, 0.09),
            "return_flag": InSet("l_returnflag", ["A", "N"]),
            "line_key": Unique(["l_orderkey", "l_linenumber"]),
            "order_exists": References("l_orderkey", t.orders.where("o_orderstatus <> 'P'"), "o_orderkey"),
        },
    )


@query(
    "volume_drift",
    """
    WITH d AS (SELECT event_type, CAST(ts AS DATE) AS dt, count(*) AS n FROM events GROUP BY ALL),
    p AS (SELECT *, sum(n) OVER w AS total, count(*) OVER w AS judged FROM d
          WINDOW w AS (PARTITION BY event_type ORDER BY dt ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING))
    SELECT event_type, CAST(dt AS VARCHAR) AS dt, n,
           CASE WHEN judged = 7 THEN CAST(total AS DOUBLE) / 7 END AS previous_mean,
           CASE WHEN judged = 7 THEN abs(n * 7 - total) * 10 > 2 * total END AS is_drift
    FROM p
    """,
)
def event_drift(t: Tables) -> DataFrame:
    daily = daily_summary(t.events, ["event_type"], "ts", {"n": ("count", "1")})
    return volume_drift(daily, ["event_type"], "n", 7, 0.2)


def _two_states(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Orders before 2000, and orders from 1996 on with one priority renamed."""
    keep = ["o_orderkey", "o_custkey", "o_orderpriority"]
    day = F.col("o_orderdate")
    renamed = F.when(F.col("o_orderpriority") == "5-LOW", "5-LOWEST").otherwise(F.col("o_orderpriority"))
    a = t.orders.where(day < F.lit("2000-01-01").cast("timestamp_ntz")).select(keep)
    b = t.orders.where(day >= F.lit("1996-01-01").cast("timestamp_ntz")).withColumn("o_orderpriority", renamed)
    return a, b.select(keep)


_STATES_SQL = """
    WITH a AS (SELECT {cols} FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01'),
    b AS (SELECT {cols} FROM (SELECT * REPLACE (CASE WHEN o_orderpriority = '5-LOW' THEN '5-LOWEST'
                                                ELSE o_orderpriority END AS o_orderpriority) FROM orders)
          WHERE o_orderdate >= TIMESTAMP '1996-01-01')
"""


_BY_KEY_SQL = (
    _STATES_SQL.format(cols="o_orderkey, o_custkey, o_orderpriority")
    + """,
    j AS (SELECT CASE WHEN b.o_orderkey IS NULL THEN 'only_left' WHEN a.o_orderkey IS NULL THEN 'only_right'
                      WHEN a.o_custkey IS NOT DISTINCT FROM b.o_custkey
                       AND a.o_orderpriority IS NOT DISTINCT FROM b.o_orderpriority THEN 'same'
                      ELSE 'different' END AS status
          FROM a FULL JOIN b ON a.o_orderkey = b.o_orderkey)
    SELECT k AS status, count(*) FILTER (status = k) AS keys
    FROM (SELECT unnest(['only_left', 'only_right', 'different', 'same', 'repeated']) AS k), j GROUP BY k
    """
)


@query("reconcile", _BY_KEY_SQL)
def order_states(t: Tables) -> DataFrame:
    a, b = _two_states(t)
    return reconcile(a, b, ["o_orderkey"])


@query("reconcile_digests", _BY_KEY_SQL)
def order_digests(t: Tables) -> DataFrame:
    """The same with rows shuffled only where digests differ."""
    a, b = _two_states(t)
    return reconcile_digests(a, b, ["o_orderkey"])


_ROWS_SQL = (
    _STATES_SQL.format(cols="o_custkey, o_orderpriority")
    + """
    SELECT 'only_left' AS status, (SELECT count(*) FROM (FROM a EXCEPT ALL FROM b)) AS keys
    UNION ALL SELECT 'only_right', (SELECT count(*) FROM (FROM b EXCEPT ALL FROM a))
    UNION ALL SELECT 'same', (SELECT count(*) FROM (FROM a INTERSECT ALL FROM b))
    """
)


@query("reconcile_rows", _ROWS_SQL)
def order_rows(t: Tables) -> DataFrame:
    """Without a key: whole rows with their multiplicity."""
    a, b = _two_states(t)
    return reconcile(a.drop("o_orderkey"), b.drop("o_orderkey"), [])


@query("reconcile_rows_digests", _ROWS_SQL)
def order_row_digests(t: Tables) -> DataFrame:
    a, b = _two_states(t)
    return reconcile_digests(a.drop("o_orderkey"), b.drop("o_orderkey"), [])
