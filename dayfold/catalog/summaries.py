"""Summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayfold.catalog.dims import SMALL_RANGES
from dayfold.catalog.facts import CUSTOMER_SQL, NET_SQL, net_sales
from dayfold.catalog.registry import Tables, query
from dayfold.functions.columns import day_of
from dayfold.operators.summaries import (
    active_bitmaps,
    active_ids,
    daily_summary,
    distinct_sketch,
    grouping_summary,
    merge_bitmaps,
    merge_quantiles,
    merge_sketch,
    period_to_date,
    pivot_summary,
    quantile_sketch,
    quantile_summary,
    to_date_merge,
    trailing_summary,
    unpivot_summary,
)

EVENT_MEASURES = {"n": ("count", "1"), "total": ("sum", "cast(value AS decimal(18,2))")}
ORDER_TOTAL = ("sum", "cast(o_totalprice AS decimal(18,2))")
ORDER_MEASURES = {"orders": ("count", "1"), "total": ORDER_TOTAL}
QUARTILES = {"p25": 0.25, "p50": 0.5, "p99": 0.99}


@query(
    "daily_summary",
    f"""
    SELECT coalesce(r_name, 'unknown') AS region, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS dt,
           CAST(sum({NET_SQL}) AS DOUBLE) AS net_sales, count(*) AS lines
    {CUSTOMER_SQL}
    GROUP BY coalesce(r_name, 'unknown'), CAST(o_orderdate AS DATE)
    """,
)
def daily_net_sales(t: Tables) -> DataFrame:
    """Daily net sales by customer region."""
    return daily_summary(
        net_sales(t), ["region"], "o_orderdate", {"net_sales": ("sum", "net"), "lines": ("count", "1")}
    )


@query(
    "trailing_summary",
    """
    WITH d AS (SELECT event_type, CAST(ts AS DATE) AS dt, count(*) AS n, sum(CAST(value AS DECIMAL(18,2))) AS total
               FROM events GROUP BY ALL)
    SELECT event_type, CAST(w AS BIGINT) AS window_days, CAST(sum(n) AS BIGINT) AS n,
           CAST(sum(total) AS DOUBLE) AS total
    FROM d, (VALUES (1), (7), (30)) AS v(w), (SELECT max(dt) AS last FROM d)
    WHERE dt > last - w AND dt <= last
    GROUP BY event_type, w
    """,
)
def trailing_events(t: Tables) -> DataFrame:
    last = t.events.agg(day_of(F.max("ts"))).scalar()
    # The filter on the time itself reaches the scan; one on its day would not.
    recent = t.events.where(F.col("ts") >= F.date_sub(last, 29).cast("timestamp_ntz"))
    daily = daily_summary(recent, ["event_type"], "ts", EVENT_MEASURES)
    return trailing_summary(daily, ["event_type"], last, EVENT_MEASURES)


@query(
    "to_date_merge",
    """
    SELECT o_custkey, CAST(CAST(min(o_orderdate) AS DATE) AS VARCHAR) AS first_day,
           CAST(CAST(max(o_orderdate) AS DATE) AS VARCHAR) AS last_day,
           count(*) AS orders, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
    FROM orders GROUP BY o_custkey
    """,
)
def customer_totals(t: Tables) -> DataFrame:
    """Totals of the days up to 1999, then the later days merged in."""
    daily = daily_summary(t.orders, ["o_custkey"], "o_orderdate", ORDER_MEASURES)
    cut = F.col("dt") < F.lit("2000-01-01").cast("date")
    earlier = to_date_merge(None, daily.where(cut), ["o_custkey"], ["orders", "total"])
    return to_date_merge(earlier, daily.where(~cut), ["o_custkey"], ["orders", "total"])


@query(
    "period_to_date",
    """
    WITH d AS (SELECT o_orderpriority, CAST(o_orderdate AS DATE) AS dt, count(*) AS orders,
                      sum(CAST(o_totalprice AS DECIMAL(18,2))) AS total FROM orders GROUP BY ALL)
    SELECT o_orderpriority, CAST(dt AS VARCHAR) AS dt, orders, CAST(total AS DOUBLE) AS total,
           CAST(sum(orders) OVER w AS BIGINT) AS orders_month_to_date,
           CAST(sum(total) OVER w AS DOUBLE) AS total_month_to_date
    FROM d WINDOW w AS (PARTITION BY o_orderpriority, date_trunc('month', dt) ORDER BY dt ROWS UNBOUNDED PRECEDING)
    """,
)
def month_to_date(t: Tables) -> DataFrame:
    daily = daily_summary(t.orders, ["o_orderpriority"], "o_orderdate", ORDER_MEASURES)
    return period_to_date(daily, ["o_orderpriority"], "month", ["orders", "total"])


_GROUPING_SQL = """
    SELECT o_orderstatus, o_orderpriority, CAST(grouping(o_orderstatus, o_orderpriority) AS BIGINT) AS grouping_id,
           count(*) AS orders, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
    FROM orders GROUP BY {}
"""


def _grouping(t: Tables, mode: str, sets: list | None = None) -> DataFrame:
    return grouping_summary(t.orders, ["o_orderstatus", "o_orderpriority"], mode, ORDER_MEASURES, sets)


@query("grouping_summary_cube", _GROUPING_SQL.format("CUBE (o_orderstatus, o_orderpriority)"))
def cube(t: Tables) -> DataFrame:
    return _grouping(t, "cube")


@query("grouping_summary_rollup", _GROUPING_SQL.format("ROLLUP (o_orderstatus, o_orderpriority)"))
def rollup(t: Tables) -> DataFrame:
    return _grouping(t, "rollup")


@query("grouping_summary_sets", _GROUPING_SQL.format("GROUPING SETS ((o_orderstatus), (o_orderpriority), ())"))
def grouping_sets(t: Tables) -> DataFrame:
    return _grouping(t, "sets", [["o_orderstatus"], ["o_orderpriority"], []])


_ACTIVE_SQL = """
    WITH a AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS dt FROM events),
    days AS (SELECT CAST(unnest(generate_series((SELECT min(dt) FROM a), (SELECT max(dt) FROM a), INTERVAL 1 DAY))
                         AS DATE) AS day),
    n AS (SELECT unnest([1, 7, 30]) AS span)
    SELECT CAST(span AS BIGINT) AS span_days, CAST(day AS VARCHAR) AS dt, count(DISTINCT user_id) AS active_ids
    FROM days CROSS JOIN n LEFT JOIN a ON dt <= day AND dt > day - span
    GROUP BY span, day
"""


@query("active_ids", _ACTIVE_SQL)
def active_users(t: Tables) -> DataFrame:
    first = t.events.agg(day_of(F.min("ts"))).scalar()
    last = t.events.agg(day_of(F.max("ts"))).scalar()
    return active_ids(t.events, "user_id", "ts", first, last)


@query("active_bitmaps", _ACTIVE_SQL)
def active_users_from_bitmaps(t: Tables) -> DataFrame:
    """The same from one stored bitmap per day and 32,768 users."""
    first = t.events.agg(day_of(F.min("ts"))).scalar()
    last = t.events.agg(day_of(F.max("ts"))).scalar()
    return merge_bitmaps(active_bitmaps(t.events, "user_id", "ts"), first, last)


@query(
    "active_customers",
    """
    WITH a AS (SELECT DISTINCT o_custkey, CAST(o_orderdate AS DATE) AS dt FROM orders),
    days AS (SELECT CAST(unnest(generate_series((SELECT min(dt) FROM a), (SELECT max(dt) FROM a), INTERVAL 1 DAY))
                         AS DATE) AS day),
    n AS (SELECT unnest([7, 90]) AS span)
    SELECT CAST(span AS BIGINT) AS span_days, CAST(day AS VARCHAR) AS dt, count(DISTINCT o_custkey) AS active_ids
    FROM days CROSS JOIN n LEFT JOIN a ON dt <= day AND dt > day - span
    GROUP BY span, day
    """,
)
def active_customers(t: Tables) -> DataFrame:
    """Orders leave gaps between a customer's days, which events do not."""
    first = t.orders.agg(day_of(F.min("o_orderdate"))).scalar()
    last = t.orders.agg(day_of(F.max("o_orderdate"))).scalar()
    return active_ids(t.orders, "o_custkey", "o_orderdate", first, last, [7, 90])


@query("distinct_sketch", "SELECT event_type, count(DISTINCT user_id) AS ids, TRUE AS within FROM events GROUP BY 1")
def sketched_users(t: Tables) -> DataFrame:
    """Users per event type, and whether the estimate from the daily sketches is within 5 % of them.

    With 2^12 registers the standard error is 1.6 %.
    """
    daily = distinct_sketch(t.events, "user_id", "ts", ["event_type"])
    exact = t.events.groupBy("event_type").agg(F.count_distinct("user_id").alias("ids"))
    both = exact.join(merge_sketch(daily, ["event_type"]), "event_type")
    within = F.abs(F.col("approx_ids") - F.col("ids")) <= F.greatest(F.lit(1), 0.05 * F.col("ids"))
    return both.select("event_type", "ids", within.alias("within"))


_QUANTILE_SQL = """
    SELECT l_returnflag, round(quantile_cont(l_extendedprice, 0.25), 4) AS p25,
           round(quantile_cont(l_extendedprice, 0.5), 4) AS p50, round(quantile_cont(l_extendedprice, 0.99), 4) AS p99
    FROM lineitem GROUP BY l_returnflag
"""


def _price_quantiles(t: Tables, **more) -> DataFrame:
    out = quantile_summary(t.lineitem, ["l_returnflag"], "l_extendedprice", QUARTILES, **more)
    return out.select("l_returnflag", *[F.round(c, 4).alias(c) for c in QUARTILES])


@query("quantile_summary", _QUANTILE_SQL)
def price_quantiles(t: Tables) -> DataFrame:
    return _price_quantiles(t)


@query("quantile_summary_split", _QUANTILE_SQL)
def price_quantiles_split(t: Tables) -> DataFrame:
    return _price_quantiles(t, split=SMALL_RANGES)


@query(
    "quantile_summary_overall",
    """
    SELECT quantile_disc(l_extendedprice, 0.25) AS p25, quantile_disc(l_extendedprice, 0.5) AS p50,
           quantile_disc(l_extendedprice, 0.99) AS p99
    FROM lineitem
    """,
)
def overall_quantiles(t: Tables) -> DataFrame:
    return quantile_summary(t.lineitem, [], "l_extendedprice", QUARTILES, "discrete", split=SMALL_RANGES)


@query(
    "quantile_summary_approx",
    """
    SELECT l_returnflag, count(l_extendedprice) AS n, TRUE AS p25, TRUE AS p50, TRUE AS p99
    FROM lineitem GROUP BY l_returnflag
    """,
)
def approx_quantiles(t: Tables) -> DataFrame:
    """Whether the rank of each approximate quantile is within its bound, a ten-thousandth of the rows."""
    approx = quantile_summary(t.lineitem, ["l_returnflag"], "l_extendedprice", QUARTILES, "approx")
    price, n = F.col("l_extendedprice"), F.col("n")
    # One row per flag: joined by a shuffle, all lines of a flag would be one task's.
    both = t.lineitem.join(F.broadcast(approx), "l_returnflag").groupBy("l_returnflag").agg(
        F.count(price).alias("n"),
        *[F.count_if(price < F.col(c)).alias(f"{c}_below") for c in QUARTILES],
        *[F.count_if(price <= F.col(c)).alias(f"{c}_upto") for c in QUARTILES],
    )
    within = [
        ((F.col(f"{c}_below") <= (q + 1e-4) * n + 1) & (F.col(f"{c}_upto") >= (q - 1e-4) * n - 1)).alias(c)
        for c, q in QUARTILES.items()
    ]
    return both.select("l_returnflag", "n", *within)


@query(
    "quantile_sketch",
    """
    SELECT l_returnflag, year(l_shipdate)::BIGINT AS year, count(l_extendedprice) AS n, TRUE AS p25, TRUE AS p50, TRUE AS p99
    FROM lineitem GROUP BY 1, 2
    """,
)
def yearly_quantiles(t: Tables) -> DataFrame:
    """Whether the rank of each quantile per year, merged from daily sketches, is within 2 % of the rows."""
    group = ["l_returnflag", "year"]
    daily = quantile_sketch(t.lineitem, "l_extendedprice", "l_shipdate", ["l_returnflag"])
    merged = merge_quantiles(daily, ["l_returnflag", F.year("dt").cast("bigint").alias("year")], QUARTILES)
    price, n = F.col("l_extendedprice"), F.col("n")
    lines = t.lineitem.withColumn("year", F.year("l_shipdate").cast("bigint"))
    both = lines.join(F.broadcast(merged), group).groupBy(*group, "n").agg(
        *[F.count_if(price < F.col(c)).alias(f"{c}_below") for c in QUARTILES],
        *[F.count_if(price <= F.col(c)).alias(f"{c}_upto") for c in QUARTILES],
    )
    within = [
        ((F.col(f"{c}_below") <= (q + 0.02) * n + 1) & (F.col(f"{c}_upto") >= (q - 0.02) * n - 1)).alias(c)
        for c, q in QUARTILES.items()
    ]
    return both.select(*group, "n", *within)


_PIVOT_SQL = """
    SELECT o_orderpriority, CAST(sum(CASE WHEN o_orderstatus = 'F' THEN p END) AS DOUBLE) AS "F",
           CAST(sum(CASE WHEN o_orderstatus = 'O' THEN p END) AS DOUBLE) AS "O",
           CAST(sum(CASE WHEN o_orderstatus = 'P' THEN p END) AS DOUBLE) AS "P"
    FROM (SELECT *, CAST(o_totalprice AS DECIMAL(18,2)) AS p FROM orders) GROUP BY o_orderpriority
"""


def _pivoted(t: Tables) -> DataFrame:
    return pivot_summary(t.orders, ["o_orderpriority"], "o_orderstatus", ["F", "O", "P"], ORDER_TOTAL)


@query("pivot_summary", _PIVOT_SQL)
def status_columns(t: Tables) -> DataFrame:
    return _pivoted(t)


@query(
    "unpivot_summary",
    """
    SELECT o_orderpriority, o_orderstatus, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
    FROM orders GROUP BY o_orderpriority, o_orderstatus
    """,
)
def status_rows(t: Tables) -> DataFrame:
    return unpivot_summary(_pivoted(t), ["o_orderpriority"], ["F", "O", "P"], "o_orderstatus", "total")
