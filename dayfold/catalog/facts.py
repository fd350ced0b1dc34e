"""Facts."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayfold.catalog.dims import HISTORY_SQL, SMALL_CELLS, SMALL_RANGES, customer_lookups, priority_history
from dayfold.catalog.registry import Tables, query
from dayfold.functions.columns import money
from dayfold.functions.hot import DEFAULT, HotSplit
from dayfold.operators.dims import Lookup
from dayfold.operators.facts import (
    accumulating_snapshot,
    allocate_header_amount,
    periodic_snapshot,
    transaction_fact,
)
from dayfold.operators.sequence import asof_join, sessionize

NET_SQL = "CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))"
CUSTOMER_SQL = """
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    LEFT JOIN customer ON o_custkey = c_custkey
    LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey
"""
SIX_HOURS = timedelta(hours=6)


def net_sales(t: Tables) -> DataFrame:
    """Order lines with the order's date, the customer's region and the net amount."""
    nation_of = {"c_nationkey": "c_nationkey"}
    customer = Lookup(t.customer, {"o_custkey": "c_custkey"}, nation_of, {"c_nationkey": -1}, unique=True)
    net = money("l_extendedprice") * (F.lit(1) - F.col("l_discount").cast("decimal(4,2)"))
    return transaction_fact(
        t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_discount"),
        t.orders,
        "l_orderkey",
        "o_orderkey",
        ["o_custkey", "o_orderdate", "o_orderstatus", "o_orderpriority"],
        [customer, *customer_lookups(t, unique=True)],
        {"net": net.cast("decimal(18,4)")},
    )


@query(
    "transaction_fact",
    f"""
    SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey,
           CAST(o_orderdate AS VARCHAR) AS o_orderdate,
           coalesce(n_name, 'unknown') AS nation, coalesce(r_name, 'unknown') AS region,
           CAST({NET_SQL} AS DOUBLE) AS net
    {CUSTOMER_SQL}
    """,
)
def sales_lines(t: Tables) -> DataFrame:
    return net_sales(t).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "o_orderdate", "nation", "region", "net"
    )


_ORDER_COLS = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
               "l_returnflag", "l_linestatus", "l_shipdate"]


def allocated(t: Tables, split: HotSplit = DEFAULT) -> tuple[DataFrame, DataFrame, DataFrame]:
    return allocate_header_amount(
        t.lineitem.withColumnRenamed("l_orderkey", "o_orderkey"),
        t.orders,
        "o_orderkey",
        "o_totalprice",
        "l_extendedprice",
        _ORDER_COLS,
        split=split,
    )


_ALLOCATE_SQL = f"""
    WITH c AS (
        SELECT l.*, CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 100 AS HUGEINT) AS amount,
               CAST(CAST(l_extendedprice AS DECIMAL(16,2)) * 100 AS HUGEINT) AS cents
        FROM lineitem l JOIN orders ON l_orderkey = o_orderkey),
    s AS (
        SELECT *, (2 * amount * cents + sum(cents) OVER (PARTITION BY l_orderkey))
                  // (2 * sum(cents) OVER (PARTITION BY l_orderkey)) AS share,
               row_number() OVER (PARTITION BY l_orderkey ORDER BY {", ".join(c + " DESC" for c in _ORDER_COLS)}) AS nth
        FROM c)
    SELECT l_orderkey AS o_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey,
           CAST(CAST(share + CASE WHEN nth = 1 THEN amount - sum(share) OVER (PARTITION BY l_orderkey) ELSE 0 END
                     AS BIGINT) / 100 AS DOUBLE) AS allocated
    FROM s
"""
_ALLOCATED = ["o_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "allocated"]


@query("allocate_header_amount", _ALLOCATE_SQL)
def shared_order_totals(t: Tables) -> DataFrame:
    return allocated(t)[0].select(_ALLOCATED)


@query("allocate_header_amount_split", _ALLOCATE_SQL)
def shared_order_totals_split(t: Tables) -> DataFrame:
    return allocated(t, SMALL_CELLS)[0].select(_ALLOCATED)


@query(
    "headers_without_lines",
    """
    SELECT o_orderkey, o_totalprice FROM orders
    WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)
    """,
)
def empty_orders(t: Tables) -> DataFrame:
    _, without, _ = allocated(t)
    return without.select("o_orderkey", "o_totalprice")


@query(
    "accumulating_snapshot",
    """
    WITH m AS (
        SELECT user_id, min(ts) FILTER (event_type = 'signup') AS signup_at,
               min(ts) FILTER (event_type = 'view') AS view_at,
               min(ts) FILTER (event_type = 'purchase') AS purchase_at
        FROM events GROUP BY user_id)
    SELECT user_id, CAST(signup_at AS VARCHAR) AS signup_at, CAST(view_at AS VARCHAR) AS view_at,
           CAST(purchase_at AS VARCHAR) AS purchase_at,
           date_diff('microsecond', signup_at, view_at) / 3.6e9 AS hours_signup_to_view,
           date_diff('microsecond', view_at, purchase_at) / 3.6e9 AS hours_view_to_purchase
    FROM m
    """,
)
def milestones(t: Tables) -> DataFrame:
    return accumulating_snapshot(t.events, "user_id", "ts", "event_type", ["signup", "view", "purchase"])


@query(
    "periodic_snapshot",
    "WITH "
    + HISTORY_SQL
    + """,
    days AS (SELECT CAST(unnest(generate_series(DATE '1998-01-01', DATE '1998-12-31', INTERVAL 1 DAY)) AS DATE) AS dt)
    SELECT CAST(dt AS VARCHAR) AS dt, o_orderpriority, count(*) AS customers
    FROM days JOIN history ON valid_from < dt + INTERVAL 1 DAY AND valid_to >= dt + INTERVAL 1 DAY
    GROUP BY dt, o_orderpriority
    """,
)
def customers_by_priority(t: Tables) -> DataFrame:
    """Customers per day and current priority over one year."""
    daily = periodic_snapshot(priority_history(t), "1998-01-01", "1998-12-31")
    return daily.groupBy("dt", "o_orderpriority").agg(F.count(F.lit(1)).alias("customers"))


SESSION_SQL = """
    waits AS (SELECT *, ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS wait FROM events),
    sessions AS (
        SELECT *, sum(CASE WHEN wait <= INTERVAL 6 HOUR THEN 0 ELSE 1 END)
                  OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS session_no
        FROM waits)
"""
_SESSIONIZE_SQL = (
    "WITH " + SESSION_SQL + "SELECT event_id, user_id, CAST(session_no AS BIGINT) AS session_no FROM sessions"
)


def sessions(t: Tables, split: HotSplit = DEFAULT) -> DataFrame:
    rows = t.events.select("event_id", "user_id", "ts")
    return sessionize(rows, "user_id", "ts", SIX_HOURS, split=split).drop("ts")


@query("sessionize", _SESSIONIZE_SQL)
def event_sessions(t: Tables) -> DataFrame:
    return sessions(t)


@query("sessionize_split", _SESSIONIZE_SQL)
def event_sessions_split(t: Tables) -> DataFrame:
    return sessions(t, SMALL_RANGES)


_ASOF_SQL = """
    WITH p AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'purchase'),
    c AS (SELECT event_id AS click_id, user_id, ts FROM events WHERE event_type = 'click')
    SELECT p.event_id, p.user_id, CAST(p.ts AS VARCHAR) AS ts, c.click_id, CAST(c.ts AS VARCHAR) AS ts_right
    FROM p ASOF LEFT JOIN c ON p.user_id = c.user_id AND p.ts >= c.ts
"""


def last_click(t: Tables, split: HotSplit = DEFAULT) -> DataFrame:
    kind = F.col("event_type")
    purchases = t.events.where(kind == "purchase").select("event_id", "user_id", "ts")
    clicks = t.events.where(kind == "click").select(F.col("event_id").alias("click_id"), "user_id", "ts")
    return asof_join(purchases, clicks, ["user_id"], "ts", split=split)


@query("asof_join", _ASOF_SQL)
def purchase_clicks(t: Tables) -> DataFrame:
    return last_click(t)


@query("asof_join_split", _ASOF_SQL)
def purchase_clicks_split(t: Tables) -> DataFrame:
    return last_click(t, SMALL_RANGES)
