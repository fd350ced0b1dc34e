"""Dimensions and history."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayfold.catalog.registry import Tables, query
from dayfold.functions.columns import day_of, surrogate_key
from dayfold.functions.hot import NO_SPLIT, HotSplit
from dayfold.operators.clean import latest_by_key
from dayfold.operators.dims import (
    Lookup,
    calendar_dim,
    denormalize_dim,
    scd1_upsert,
    scd2_apply,
    scd2_build,
    scd2_lookup,
)
from dayfold.operators.stored import scd2_apply_stored, stored_history, upsert_stored
from dayfold.session import tidy, work_folder, written
from dayfold.sources.buckets import BucketStore
from dayfold.sources.load import write_day

# Limits low enough that the small tables have hot groups too: some lanes for each, and some ranges for all.
SMALL_CELLS = HotSplit(min_rows=5, rows_per_cell=3)
SMALL_RANGES = HotSplit(min_rows=5, rows_per_cell=2500)

# History of the order priority per customer.
HISTORY_SQL = """
    last_of_day AS (
        SELECT o_custkey, o_orderdate, o_orderpriority
        FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderdate ORDER BY o_orderkey DESC) AS nth
              FROM orders) WHERE nth = 1),
    compared AS (
        SELECT *, lag(o_orderpriority) OVER w AS before, row_number() OVER w AS nth
        FROM last_of_day WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate)),
    history AS (
        SELECT o_custkey, o_orderpriority, o_orderdate AS valid_from,
               coalesce(lead(o_orderdate) OVER w, TIMESTAMP '9999-12-31') AS valid_to,
               lead(o_orderdate) OVER w IS NULL AS is_current
        FROM compared WHERE nth = 1 OR before IS DISTINCT FROM o_orderpriority
        WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate))
"""
_SHOW_HISTORY = """
    SELECT o_custkey, o_orderpriority, CAST(valid_from AS VARCHAR) AS valid_from,
           CAST(valid_to AS VARCHAR) AS valid_to, is_current FROM history
"""


def customer_lookups(t: Tables, unique: bool = False) -> list[Lookup]:
    nation = {"nation": "n_name", "n_regionkey": "n_regionkey"}
    return [
        Lookup(t.nation, {"c_nationkey": "n_nationkey"}, nation, {"n_regionkey": -1}, unique),
        Lookup(t.region, {"n_regionkey": "r_regionkey"}, {"region": "r_name"}, {}, unique),
    ]


def priority_history(t: Tables, split: HotSplit | None = None) -> DataFrame:
    more = {} if split is None else {"split": split}
    return scd2_build(t.orders, ["o_custkey"], "o_orderdate", ["o_orderpriority"], ["o_orderkey"], **more)


@query(
    "denormalize_dim",
    """
    SELECT sha256(length(CAST(c_custkey AS VARCHAR)) || ':' || CAST(c_custkey AS VARCHAR)) AS customer_sk,
           c_custkey, c_mktsegment, coalesce(n_name, 'unknown') AS nation, coalesce(r_name, 'unknown') AS region
    FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey
    """,
)
def customer_dim(t: Tables) -> DataFrame:
    dim = denormalize_dim(t.customer, customer_lookups(t))
    return dim.select(surrogate_key("c_custkey").alias("customer_sk"), "c_custkey", "c_mktsegment", "nation", "region")


_UPSERT_SQL = """
    WITH ranked AS (
        SELECT *, o_orderdate < TIMESTAMP '1998-01-01' AS is_old,
               row_number() OVER (PARTITION BY o_custkey, o_orderdate < TIMESTAMP '1998-01-01'
                                  ORDER BY o_orderdate DESC, o_orderkey DESC) AS nth FROM orders),
    cur AS (SELECT * FROM ranked WHERE is_old AND nth = 1),
    chg AS (SELECT * FROM ranked WHERE NOT is_old AND nth = 1)
    SELECT o_custkey, o_orderkey, o_orderpriority FROM chg
    UNION ALL
    SELECT o_custkey, o_orderkey, o_orderpriority FROM cur WHERE o_custkey NOT IN (SELECT o_custkey FROM chg)
"""


def _orders_before_and_after(t: Tables) -> tuple[DataFrame, DataFrame]:
    """The latest order per customer: as of 1997 as the table, of later years as its changes."""
    keep = ["o_custkey", "o_orderkey", "o_orderpriority"]
    old = F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz")
    order = ["o_orderdate", "o_orderkey"]
    current = latest_by_key(t.orders.where(old), ["o_custkey"], order).select(keep)
    changes = latest_by_key(t.orders.where(~old), ["o_custkey"], order).select(keep)
    return current, changes


@query("scd1_upsert", _UPSERT_SQL)
def upserted_orders(t: Tables) -> DataFrame:
    return scd1_upsert(*_orders_before_and_after(t), ["o_custkey"])


@query("scd1_upsert_stored", _UPSERT_SQL)
def upserted_store(t: Tables) -> DataFrame:
    """The same with the table kept in buckets of the customer."""
    current, changes = _orders_before_and_after(t)
    store = BucketStore(t.spark, work_folder(t.spark, "latest-orders"), current.schema, ["o_custkey"], 32)
    store.replace(current)
    upsert_stored(store, changes)
    return store.read()


@query("scd2_build", "WITH " + HISTORY_SQL + _SHOW_HISTORY)
def history(t: Tables) -> DataFrame:
    return priority_history(t)


@query("scd2_build_split", "WITH " + HISTORY_SQL + _SHOW_HISTORY)
def history_split(t: Tables) -> DataFrame:
    return priority_history(t, SMALL_RANGES)


@query("scd2_apply", "WITH " + HISTORY_SQL + _SHOW_HISTORY)
def history_by_days(t: Tables) -> DataFrame:
    """History up to the last order day, then that day applied."""
    day = t.orders.agg(F.max("o_orderdate")).scalar()
    before = scd2_build(
        t.orders.where(F.col("o_orderdate") < day), ["o_custkey"], "o_orderdate", ["o_orderpriority"], ["o_orderkey"]
    )
    changes = latest_by_key(t.orders.where(F.col("o_orderdate") == day), ["o_custkey"], ["o_orderkey"])
    return scd2_apply(before, changes, day, ["o_custkey"], ["o_orderpriority"])


@query("scd2_apply_stored", "WITH " + HISTORY_SQL + _SHOW_HISTORY)
def stored_history_by_days(t: Tables) -> DataFrame:
    """History up to the last order day in buckets of the customer, then that day applied to those it touches."""
    day = t.orders.agg(day_of(F.max("o_orderdate"))).first()[0]
    of_day = day_of("o_orderdate") == F.lit(day)
    keys, attrs = ["o_custkey"], ["o_orderpriority"]
    before = scd2_build(t.orders.where(~of_day), keys, "o_orderdate", attrs, ["o_orderkey"])
    store = BucketStore(t.spark, work_folder(t.spark, "open-versions"), before.schema, keys, 32)
    closed = work_folder(t.spark, "closed-versions")
    with tidy():
        before = written(before, "history-before")
        store.replace(before.where("is_current"))
        write_day(before.where("NOT is_current"), closed, day - timedelta(days=1))
    scd2_apply_stored(store, closed, latest_by_key(t.orders.where(of_day), keys, ["o_orderkey"]), day, attrs)
    return stored_history(store, closed)


_LOOKUP_SQL = (
    "WITH "
    + HISTORY_SQL
    + """
    SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey, o.o_custkey,
           CAST(l_shipdate AS VARCHAR) AS l_shipdate,
           coalesce(h.o_orderpriority, 'unknown') AS priority
    FROM lineitem JOIN orders o ON l_orderkey = o_orderkey
    LEFT JOIN history h ON h.o_custkey = o.o_custkey AND l_shipdate >= valid_from AND l_shipdate < valid_to
    """
)


def _lookup(t: Tables, **more) -> DataFrame:
    lines = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "o_custkey", "l_shipdate"
    )
    return scd2_lookup(
        lines, priority_history(t, NO_SPLIT), {"o_custkey": "o_custkey"}, "l_shipdate", {"priority": "o_orderpriority"}, **more
    )


@query("scd2_lookup", _LOOKUP_SQL)
def lookup(t: Tables) -> DataFrame:
    return _lookup(t, small=False)


@query("scd2_lookup_split", _LOOKUP_SQL)
def lookup_split(t: Tables) -> DataFrame:
    """By levels, as with a history that is broadcast."""
    return _lookup(t, small=True)


@query(
    "calendar_dim",
    """
    WITH days AS (
        SELECT CAST(unnest(generate_series((SELECT min(o_orderdate) FROM orders), (SELECT max(o_orderdate) FROM orders),
                                           INTERVAL 1 DAY)) AS DATE) AS dt),
    n AS (SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS orders FROM orders GROUP BY 1)
    SELECT CAST(dt AS VARCHAR) AS dt, year(dt) AS year, quarter(dt) AS quarter, month(dt) AS month,
           weekofyear(dt) AS iso_week, isodow(dt) AS iso_weekday, isodow(dt) >= 6 AS is_weekend,
           dt = last_day(dt) AS is_month_end, coalesce(orders, 0) AS orders
    FROM days LEFT JOIN n ON dt = day
    """,
)
def calendar_with_orders(t: Tables) -> DataFrame:
    """Orders per calendar day, days without orders included."""
    first = t.orders.agg(day_of(F.min("o_orderdate"))).scalar()
    last = t.orders.agg(day_of(F.max("o_orderdate"))).scalar()
    per_day = t.orders.groupBy(day_of("o_orderdate").alias("day")).agg(F.count(F.lit(1)).alias("orders"))
    return (
        calendar_dim(t.spark, first, last)
        .join(per_day, F.col("dt") == F.col("day"), "left")
        .drop("day")
        .na.fill(0, ["orders"])
    )
