"""Report metrics."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayfold.catalog.dims import SMALL_RANGES
from dayfold.catalog.facts import SESSION_SQL, SIX_HOURS
from dayfold.catalog.registry import Tables, query
from dayfold.functions.columns import money, period_start
from dayfold.functions.hot import DEFAULT, HotSplit
from dayfold.operators.metrics import (
    cohort_value,
    funnel,
    lifecycle,
    new_ids,
    period_growth,
    period_set_compare,
    repeat_rate,
    retention_matrix,
    rfm_segments,
    streaks,
    topk_per_group,
    transitions,
)
from dayfold.sources.load import load_increment


@query(
    "new_ids",
    """
    SELECT CAST(CAST(date_trunc('month', first) AS DATE) AS VARCHAR) AS period, count(*) AS new_ids
    FROM (SELECT min(o_orderdate) AS first FROM orders GROUP BY o_custkey) GROUP BY date_trunc('month', first)
    """,
)
def new_customers(t: Tables) -> DataFrame:
    return new_ids(t.orders, "o_custkey", "o_orderdate", "month")


_COHORT_SQL = """
    WITH a AS (SELECT o_custkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS period,
                      sum(CAST(o_totalprice AS DECIMAL(18,2))) AS spend
               FROM orders GROUP BY ALL),
    c AS (SELECT *, min(period) OVER (PARTITION BY o_custkey) AS cohort FROM a),
    n AS (SELECT cohort, date_diff('month', cohort, period) AS "offset", count(*) AS ids, sum(spend) AS spend
          FROM c GROUP BY ALL),
    s AS (SELECT cohort AS c0, ids AS members FROM n WHERE "offset" = 0)
"""


@query(
    "retention_matrix",
    _COHORT_SQL
    + """
    SELECT CAST(cohort AS VARCHAR) AS cohort, "offset", ids AS active_ids, ids / members AS rate
    FROM n JOIN s ON cohort = c0
    """,
)
def order_retention(t: Tables) -> DataFrame:
    return retention_matrix(t.orders, "o_custkey", "o_orderdate", "month")


@query(
    "lifecycle",
    """
    WITH a AS (SELECT DISTINCT o_custkey, year(o_orderdate) AS y FROM orders),
    s AS (SELECT *, lag(y) OVER w AS p, lead(y) OVER w AS n FROM a WINDOW w AS (PARTITION BY o_custkey ORDER BY y)),
    k AS (SELECT y, CASE WHEN p IS NULL THEN 'new' WHEN y - p = 1 THEN 'retained' ELSE 'returning' END AS kind FROM s
          UNION ALL SELECT y + 1, 'lapsed' FROM s WHERE n IS NULL OR n > y + 1)
    SELECT CAST(make_date(y, 1, 1) AS VARCHAR) AS period, count(*) FILTER (kind = 'new') AS new_ids,
           count(*) FILTER (kind = 'retained') AS retained_ids, count(*) FILTER (kind = 'returning') AS returning_ids,
           count(*) FILTER (kind = 'lapsed') AS lapsed_ids
    FROM k WHERE y <= (SELECT max(y) FROM a) GROUP BY y
    """,
)
def customer_lifecycle(t: Tables) -> DataFrame:
    return lifecycle(t.orders, "o_custkey", "o_orderdate", "year")


@query(
    "streaks",
    """
    WITH a AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS dt FROM events),
    g AS (SELECT *, dt - CAST(row_number() OVER (PARTITION BY user_id ORDER BY dt) AS INTEGER) AS run FROM a)
    SELECT user_id, CAST(min(dt) AS VARCHAR) AS start_day, CAST(max(dt) AS VARCHAR) AS end_day, count(*) AS days
    FROM g GROUP BY user_id, run
    """,
)
def user_streaks(t: Tables) -> DataFrame:
    return streaks(t.events, "user_id", "ts")


_FUNNEL_SQL = """
    WITH v AS (SELECT user_id, min(ts) AS t1 FROM events WHERE event_type = 'view' GROUP BY user_id),
    c AS (SELECT v.user_id, t1, min(ts) AS t2 FROM v JOIN events e ON e.user_id = v.user_id
          WHERE event_type = 'click' AND ts > t1 AND ts <= t1 + INTERVAL 24 HOUR GROUP BY ALL),
    p AS (SELECT c.user_id, min(ts) AS t3 FROM c JOIN events e ON e.user_id = c.user_id
          WHERE event_type = 'purchase' AND ts > t2 AND ts <= t1 + INTERVAL 24 HOUR GROUP BY ALL)
    SELECT CAST(1 AS BIGINT) AS step, 'view' AS kind, (SELECT count(*) FROM v) AS ids
    UNION ALL SELECT 2, 'click', (SELECT count(*) FROM c)
    UNION ALL SELECT 3, 'purchase', (SELECT count(*) FROM p)
"""


def _funnel(t: Tables, split: HotSplit = DEFAULT) -> DataFrame:
    steps = ["view", "click", "purchase"]
    return funnel(t.events, "user_id", "ts", "event_type", steps, timedelta(hours=24), split)


@query("funnel", _FUNNEL_SQL)
def purchase_funnel(t: Tables) -> DataFrame:
    return _funnel(t)


@query("funnel_split", _FUNNEL_SQL)
def purchase_funnel_split(t: Tables) -> DataFrame:
    return _funnel(t, SMALL_RANGES)


_TOP_SQL = """
    SELECT CAST(c_nationkey AS BIGINT) AS c_nationkey, c_custkey, {metric} AS metric, place
    FROM (SELECT *, {rank}() OVER (PARTITION BY c_nationkey ORDER BY {metric} DESC{tie}) AS place FROM customer)
    WHERE place <= 3
"""


@query("topk_per_group", _TOP_SQL.format(metric="c_acctbal", rank="row_number", tie=", c_custkey"))
def richest_customers(t: Tables) -> DataFrame:
    top = topk_per_group(t.customer, ["c_nationkey"], "c_acctbal", 3, tiebreak=["c_custkey"])
    return top.select("c_nationkey", "c_custkey", F.col("c_acctbal").alias("metric"), "place")


_BRAND_TOP_SQL = """
    SELECT p_brand, p_partkey, CAST(p_size AS BIGINT) AS p_size, place
    FROM (SELECT *, {rank}() OVER (PARTITION BY p_brand ORDER BY p_size DESC) AS place FROM part) WHERE place <= 5
"""


@query("topk_per_group_rank", _BRAND_TOP_SQL.format(rank="rank"))
def largest_parts_rank(t: Tables) -> DataFrame:
    top = topk_per_group(t.part, ["p_brand"], "p_size", 5, "rank")
    return top.select("p_brand", "p_partkey", "p_size", "place")


@query("topk_per_group_dense", _BRAND_TOP_SQL.format(rank="dense_rank"))
def largest_parts_dense(t: Tables) -> DataFrame:
    top = topk_per_group(t.part, ["p_brand"], "p_size", 5, "dense_rank")
    return top.select("p_brand", "p_partkey", "p_size", "place")


@query(
    "period_growth",
    """
    WITH m AS (SELECT o_orderpriority, CAST(date_trunc('month', o_orderdate) AS DATE) AS month,
                      sum(CAST(o_totalprice AS DECIMAL(18,2))) AS total FROM orders GROUP BY ALL)
    SELECT m.o_orderpriority, CAST(m.month AS VARCHAR) AS month, CAST(m.total AS DOUBLE) AS total,
           CAST(p.total AS DOUBLE) AS previous, CAST(y.total AS DOUBLE) AS last_year,
           CAST(m.total AS DOUBLE) / CAST(p.total AS DOUBLE) - 1 AS growth,
           CAST(m.total AS DOUBLE) / CAST(y.total AS DOUBLE) - 1 AS growth_on_year
    FROM m LEFT JOIN m p ON p.o_orderpriority = m.o_orderpriority AND p.month = m.month - INTERVAL 1 MONTH
    LEFT JOIN m y ON y.o_orderpriority = m.o_orderpriority AND y.month = m.month - INTERVAL 1 YEAR
    """,
)
def monthly_growth(t: Tables) -> DataFrame:
    monthly = t.orders.groupBy("o_orderpriority", period_start("o_orderdate", "month").alias("month")).agg(
        F.sum(money("o_totalprice")).alias("total")
    )
    return period_growth(monthly, ["o_orderpriority"], "month", "month", "total")


@query(
    "repeat_rate",
    """
    WITH b AS (SELECT p_brand, o_custkey, count(DISTINCT o_orderkey) AS orders
               FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey GROUP BY ALL)
    SELECT p_brand, count(*) AS buyers, count(*) FILTER (orders >= 3) AS repeat_buyers,
           count(*) FILTER (orders >= 3) / count(*) AS rate
    FROM b GROUP BY p_brand
    """,
)
def brand_repeats(t: Tables) -> DataFrame:
    lines = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).join(
        t.part, F.col("l_partkey") == F.col("p_partkey")
    )
    return repeat_rate(lines, ["p_brand"], "o_custkey", "o_orderkey", times=3)


_TRANSITIONS_SQL = (
    "WITH "
    + SESSION_SQL
    + """,
    n AS (SELECT event_type, coalesce(lead(event_type) OVER (PARTITION BY user_id, session_no ORDER BY ts), 'exit')
                 AS to_event FROM sessions)
    SELECT event_type AS from_event, to_event, count(*) AS n FROM n GROUP BY event_type, to_event
    """
)


def _transitions(t: Tables, split: HotSplit = DEFAULT) -> DataFrame:
    return transitions(t.events, "user_id", "ts", "event_type", SIX_HOURS, ["event_id"], split)


@query("transitions", _TRANSITIONS_SQL)
def event_transitions(t: Tables) -> DataFrame:
    return _transitions(t)


@query("transitions_split", _TRANSITIONS_SQL)
def event_transitions_split(t: Tables) -> DataFrame:
    return _transitions(t, SMALL_RANGES)


_CUTS = ", ".join(
    f"quantile_disc({m}, {q}) AS {m[0]}{i}"
    for m in ("recency", "frequency", "monetary")
    for i, q in enumerate((0.2, 0.4, 0.6, 0.8), start=1)
)


def _score(measure: str) -> str:
    return " + ".join(f"CAST({measure} > {measure[0]}{i} AS BIGINT)" for i in range(1, 5))


_RFM_SQL = f"""
    WITH p AS (SELECT o_custkey, date_diff('day', CAST(max(o_orderdate) AS DATE), DATE '2001-08-01') AS recency,
                      count(*) AS frequency, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS monetary
               FROM orders WHERE o_orderdate < TIMESTAMP '2001-08-02' GROUP BY o_custkey),
    q AS (SELECT {_CUTS} FROM p)
    SELECT o_custkey, recency AS recency_days, frequency, CAST(monetary AS DOUBLE) AS monetary,
           5 - ({_score("recency")}) AS r_score,
           1 + {_score("frequency")} AS f_score, 1 + {_score("monetary")} AS m_score
    FROM p, q
"""


@query("rfm_segments", _RFM_SQL)
def customer_segments(t: Tables) -> DataFrame:
    return rfm_segments(t.orders, "o_custkey", "o_orderdate", "o_totalprice", "2001-08-01")


@query("rfm_segments_split", _RFM_SQL)
def customer_segments_split(t: Tables) -> DataFrame:
    return rfm_segments(t.orders, "o_custkey", "o_orderdate", "o_totalprice", "2001-08-01", split=SMALL_RANGES)


@query(
    "cohort_value",
    _COHORT_SQL
    + """
    SELECT CAST(cohort AS VARCHAR) AS cohort, "offset", members, CAST(spend AS DOUBLE) AS spend,
           CAST(sum(spend) OVER w AS DOUBLE) AS running_spend,
           CAST(sum(spend) OVER w AS DOUBLE) / members AS spend_per_member
    FROM n JOIN s ON cohort = c0
    WINDOW w AS (PARTITION BY cohort ORDER BY "offset" ROWS UNBOUNDED PRECEDING)
    """,
)
def order_cohort_value(t: Tables) -> DataFrame:
    return cohort_value(t.orders, "o_custkey", "o_orderdate", "o_totalprice", "month")


@query(
    "period_set_compare",
    """
    SELECT o_custkey, CASE WHEN in_a AND in_b THEN 'kept' WHEN in_a THEN 'lost' ELSE 'gained' END AS status
    FROM (SELECT o_custkey, bool_or(year(o_orderdate) = 1996) AS in_a, bool_or(year(o_orderdate) = 1997) AS in_b
          FROM orders WHERE year(o_orderdate) IN (1996, 1997) GROUP BY o_custkey)
    """,
)
def customers_kept(t: Tables) -> DataFrame:
    def of(year: int) -> DataFrame:
        return load_increment(t.orders, "o_orderdate", f"{year}-01-01", f"{year + 1}-01-01")

    return period_set_compare(of(1996), of(1997), "o_custkey")
