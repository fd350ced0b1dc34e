"""The daily batch: one day of orders through every layer.

Each run reads the day's increment and the state that the run before it left,
and replaces that day's folder in every table. Running a day again therefore
gives the same tables, and other days are not touched.

Tables below the warehouse folder, all by ``dt``:

- ``rejects``: lines that break a rule, with the reasons
- ``sales``: lines with order, customer and region
- ``region_daily``: net sales per region
- ``customer_to_date``: first day, last day and totals per customer after the day
- ``priority_closed``: versions of the customer's priority that ended on the day
- ``priority_current``: the version open after the day, one row per customer

With ``keep_late`` also:

- ``headers``: key, customer and date of the day's orders, in buckets of the key
- ``pending``: lines that have landed and whose order has not
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dayfold.functions.columns import money
from dayfold.operators.clean import latest_by_key, split_valid
from dayfold.operators.dims import Lookup, scd2_apply
from dayfold.operators.facts import transaction_fact
from dayfold.operators.summaries import daily_summary, to_date_merge
from dayfold.session import tidy, written
from dayfold.sources.buckets import BUCKET, bucket_of
from dayfold.sources.load import load_increment, read_days, write_day

HEADER_BUCKETS = 256
TO_DATE = "o_custkey bigint, first_day date, last_day date, lines bigint, net_sales decimal(28,4)"
VERSION = (
    "o_custkey bigint, o_orderpriority string, valid_from timestamp_ntz, valid_to timestamp_ntz, is_current boolean"
)


@dataclass(frozen=True)
class Warehouse:
    """Where the sources come from and where the tables go.

    ``source(name, day)`` gives what landed for ``orders`` and ``lineitem``, and
    the current table of a dimension. With landed tables kept by day it returns
    that day's folder, so that a run reads its own day and no more.

    ``keep_late`` is for such sources, which hand out every line once: a line that lands
    after its order's day is sold on the day it lands, and one that lands before its order waits
    in ``pending``, so that none is lost. Without it a run takes the lines of its own orders
    alone, as is right for a source that always hands out all lines.
    """

    spark: SparkSession
    source: Callable[[str, date], DataFrame]
    path: str
    keep_late: bool = False

    def table(self, name: str) -> str:
        return f"{self.path}/{name}"

    def state(self, name: str, schema: str, day: date | None) -> DataFrame:
        """What the run of ``day`` left; empty before the first run."""
        if day is None:
            return self.spark.createDataFrame([], schema)
        table = read_days(self.spark, self.table(name), schema)
        return table.where(F.col("dt") == F.lit(day)).drop("dt")


def customer_chain(wh: Warehouse, day: date) -> list[Lookup]:
    """Customer, nation and region of an order; their keys are unique."""
    customer, nation, region = (wh.source(name, day) for name in ("customer", "nation", "region"))
    return [
        Lookup(customer, {"o_custkey": "c_custkey"}, {"c_nationkey": "c_nationkey"}, {"c_nationkey": -1}, True),
        Lookup(nation, {"c_nationkey": "n_nationkey"}, {"n_regionkey": "n_regionkey"}, {"n_regionkey": -1}, True),
        Lookup(region, {"n_regionkey": "r_regionkey"}, {"region": "r_name"}, {}, True),
    ]


def _with_late(
    wh: Warehouse, landed: DataFrame, orders: DataFrame, day: date, previous: date | None
) -> tuple[DataFrame, DataFrame]:
    """Lines and orders to process: those of the day, and those that waited or came late.

    Headers are kept by day and bucket of the order. Lines of the day's own orders need none of them; the
    others are looked up in the buckets of their orders only. Of an order that landed more than once the last header counts.
    """
    columns = landed.columns
    landed = written(landed.unionByName(wh.state("pending", landed.schema, previous)), "landed-lines")
    todays = written(orders.select("o_orderkey", "o_custkey", "o_orderdate"), "todays-orders")
    marked = todays.withColumn(BUCKET, bucket_of(["o_orderkey"], HEADER_BUCKETS))
    write_day(marked, wh.table("headers"), day, within=[BUCKET])
    same = F.col("l_orderkey") == F.col("o_orderkey")
    own = landed.join(todays.select("o_orderkey"), same, "left_semi")
    others = written(landed.join(todays.select("o_orderkey"), same, "left_anti"), "other-lines")
    before = written(_headers_of(wh, others, todays, day), "headers-before")
    write_day(others.join(before.select("o_orderkey"), same, "left_anti"), wh.table("pending"), day)
    late = others.join(before.select("o_orderkey"), same, "left_semi")
    lines = written(own.select(columns).unionByName(late.select(columns)), "lines-with-orders")
    known = todays.unionByName(before)
    return lines, known.join(lines.select("l_orderkey").distinct(), same, "left_semi")


def _headers_of(wh: Warehouse, lines: DataFrame, like: DataFrame, day: date) -> DataFrame:
    """The last header before ``day`` of each order of ``lines``, from the buckets of these orders alone."""
    keys = lines.select(F.col("l_orderkey").alias("o_orderkey")).distinct()
    # At most HEADER_BUCKETS numbers.
    touched = [r[0] for r in keys.select(bucket_of(["o_orderkey"], HEADER_BUCKETS)).distinct().collect()]
    schema = T.StructType([*like.schema.fields, T.StructField(BUCKET, T.IntegerType())])
    stored = read_days(wh.spark, wh.table("headers"), schema)
    stored = stored.where((F.col("dt") < F.lit(day)) & F.col(BUCKET).isin(touched)).drop(BUCKET)
    return latest_by_key(stored.join(keys, "o_orderkey", "left_semi"), ["o_orderkey"], ["dt"]).select(*like.columns)


def run_day(wh: Warehouse, day: date, previous: date | None) -> None:
    """Process ``day`` on top of the state after ``previous`` (None for the first run)."""
    if previous is not None and previous >= day:
        raise ValueError(f"{day} must come after {previous}")
    with tidy():
        _run_day(wh, day, previous)


def _run_day(wh: Warehouse, day: date, previous: date | None) -> None:
    landed = load_increment(wh.source("orders", day), "o_orderdate", day, day + timedelta(days=1))
    # An order that landed twice on the day is one order still.
    orders = latest_by_key(landed, ["o_orderkey"], ["o_orderdate", "o_custkey", "o_orderpriority"])
    lines, of_lines = wh.source("lineitem", day), orders
    if wh.keep_late:
        lines, of_lines = _with_late(wh, lines, orders, day, previous)
    else:
        of_day = orders.select("o_orderkey")
        lines = written(lines.join(of_day, F.col("l_orderkey") == F.col("o_orderkey"), "left_semi"), "day-lines")
    valid, rejected = split_valid(
        lines,
        {
            "quantity": F.col("l_quantity") > 0,
            "discount": F.col("l_discount").between(0, 0.09),
        },
    )
    write_day(rejected, wh.table("rejects"), day)

    net = money("l_extendedprice") * (F.lit(1) - F.col("l_discount").cast("decimal(4,2)"))
    sales = transaction_fact(
        valid,
        of_lines,
        "l_orderkey",
        "o_orderkey",
        ["o_custkey", "o_orderdate"],
        customer_chain(wh, day),
        {"net": net.cast("decimal(18,4)"), "dt": F.lit(day)},
    )
    write_day(sales, wh.table("sales"), day)
    # From here on read the day back: it is small, and reading beats joining again.
    sold = read_days(wh.spark, wh.table("sales"), sales.schema).where(F.col("dt") == F.lit(day))

    measures = {"lines": ("count", "1"), "net_sales": ("sum", "net")}
    write_day(daily_summary(sold, ["region"], "dt", measures), wh.table("region_daily"), day)

    per_customer = daily_summary(sold, ["o_custkey"], "dt", measures)
    before = wh.state("customer_to_date", TO_DATE, previous)
    after = to_date_merge(before, per_customer, ["o_custkey"], ["lines", "net_sales"])
    write_day(after, wh.table("customer_to_date"), day)

    changes = latest_by_key(orders, ["o_custkey"], ["o_orderkey"])
    current = wh.state("priority_current", VERSION, previous)
    versions = written(scd2_apply(current, changes, day, ["o_custkey"], ["o_orderpriority"]), "versions")
    write_day(versions.where("NOT is_current"), wh.table("priority_closed"), day)
    write_day(versions.where("is_current"), wh.table("priority_current"), day)


def run_days(wh: Warehouse, days: Sequence[date], previous: date | None = None) -> None:
    """Process days in order; a loop over days, never over rows."""
    for day in sorted(days):
        run_day(wh, day, previous)
        previous = day


def priority_history(wh: Warehouse, as_of: date) -> DataFrame:
    """The whole history after the run of ``as_of``, from its two tables."""
    closed = read_days(wh.spark, wh.table("priority_closed"), VERSION)
    closed = closed.where(F.col("dt") <= F.lit(as_of)).drop("dt")
    return closed.unionByName(wh.state("priority_current", VERSION, as_of))
