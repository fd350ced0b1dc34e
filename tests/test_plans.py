"""Plan shapes, the daily batch and settings."""

import re
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entries
from dayfold import catalog
from dayfold.operators import (
    Lookup,
    denormalize_dim,
    latest_by_key,
    orphan_rows,
    scd2_build,
    scd2_lookup,
    topk_per_group,
    transaction_fact,
)
from dayfold.plans.daily import Warehouse, priority_history, run_day, run_days
from dayfold.session import work_folder
from dayfold.sources.tables import read_table

# Aggregates over everything, or over a handful of rows such as a funnel's counts.
ONE_ROW = {
    "funnel",
    "funnel_split",
    "profile_columns",
    "reconcile",
    "reconcile_digests",
    "reconcile_rows",
    "reconcile_rows_digests",
    "rule_audit",
}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", list(catalog.QUERIES))
def test_no_operator_gathers_everything(spark, folder, name):
    text = plan_of(entries.queries()[name](spark, folder))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert not re.search(r"BatchEvalPython|ArrowEvalPython|MapInPandas|FlatMapGroupsInPandas", text)
    # Scalar subqueries are aggregates of one row; look at the rest of the plan.
    main = re.sub(r"Subquery subquery.*?(?=\n\S|\Z)", "", text, flags=re.S)
    lines = main.splitlines()
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line and name not in ONE_ROW:
            above = " ".join(lines[max(0, i - 2) : i])
            assert "HashAggregate(keys=[]" in above or "SortAggregate(key=[]" in above, above


def test_group_limit_runs_below_the_shuffle(spark, folder):
    orders = read_table(spark, folder, "orders")
    for df in (
        latest_by_key(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"]),
        topk_per_group(orders, ["o_custkey"], "o_totalprice", 3, tiebreak=["o_orderkey"]),
    ):
        assert re.search(r"WindowGroupLimit.*Final.*Exchange.*WindowGroupLimit.*Partial", plan_of(df), re.S)


def test_history_shuffles_twice_when_no_key_is_hot(spark, folder):
    orders = read_table(spark, folder, "orders")
    df = scd2_build(orders, ["o_custkey"], "o_orderdate", ["o_orderpriority"], ["o_orderkey"])
    df.collect()
    final = plan_of(df).split("== Initial Plan ==")[0]
    assert final.count("Exchange hashpartitioning") == 2 and "Join" not in final


def test_scan_reads_only_what_is_used(spark, folder):
    text = plan_of(entries.queries()["streaks"](spark, folder))
    assert "struct<ts:timestamp_ntz,user_id:bigint>" in text


@pytest.fixture
def no_broadcast(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_joins_split_a_hot_key(spark, no_broadcast):
    """A third of all rows has one key; the joins must be such that AQE can split it."""
    rows = spark.range(0, 300_000, 1, 8).select(
        "id",
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") % 5000).alias("key"),
        F.timestamp_seconds("id").cast("timestamp_ntz").alias("ts"),
    )
    side = spark.range(5000).select((F.col("id") - 1).alias("k"), F.lit("x").alias("v"))
    history = side.select(
        F.col("k"),
        "v",
        F.lit("1970-01-01").cast("timestamp_ntz").alias("valid_from"),
        F.lit("9999-12-31").cast("timestamp_ntz").alias("valid_to"),
    )
    joins = {
        "orphans": orphan_rows(rows, side, {"key": "k"}),
        "lookup": denormalize_dim(rows, [Lookup(side, {"key": "k"}, {"v": "v"})]),
        "unique lookup": denormalize_dim(rows, [Lookup(side, {"key": "k"}, {"v": "v"}, unique=True)]),
        "versions": scd2_lookup(rows, history, {"key": "k"}, "ts", {"v": "v"}),
        "fact": transaction_fact(rows, side, "key", "k", ["v"]),
    }
    for name, df in joins.items():
        df = df.select(F.xxhash64(*df.columns).alias("h")).agg(F.max("h"))
        df.collect()
        assert "skew=true" in plan_of(df).split("== Initial Plan ==")[0], name


@pytest.fixture(scope="module")
def days():
    return [date(1998, 3, 1) + timedelta(days=d) for d in range(4)]


def warehouse(spark, folder, days):
    # Every order moved to one of the days, so that keys meet again.
    moved = F.date_add(F.lit(days[0]), (F.col("o_orderkey") % len(days)).cast("int")).cast("timestamp_ntz")

    def source(name, day):
        table = read_table(spark, folder, name)
        return table.withColumn("o_orderdate", moved) if name == "orders" else table

    return Warehouse(spark, source, work_folder(spark, "warehouse"))


def tables(spark, wh):
    names = ("rejects", "sales", "region_daily", "customer_to_date", "priority_closed", "priority_current")
    out = {}
    for n in names:
        df = spark.read.parquet(wh.table(n))
        out[n] = sorted(map(str, df.select(*sorted(df.columns)).collect()))
    return out


def test_daily_batch(spark, folder, days):
    wh = warehouse(spark, folder, days)
    run_days(wh, days)
    after = tables(spark, wh)
    assert len(after["sales"]) + len(after["rejects"]) == read_table(spark, folder, "lineitem").count()
    assert after["rejects"] and after["priority_closed"]

    # A rerun of the last day, and of a day in between followed by the later ones.
    run_day(wh, days[-1], days[-2])
    assert tables(spark, wh) == after
    run_days(wh, days[2:], days[1])
    assert tables(spark, wh) == after

    built = scd2_build(wh.source("orders", days[-1]), ["o_custkey"], "o_orderdate", ["o_orderpriority"], ["o_orderkey"])
    history = priority_history(wh, days[-1]).select(built.columns)
    assert sorted(map(str, history.collect())) == sorted(map(str, built.collect()))

    totals = spark.read.parquet(wh.table("customer_to_date")).where(F.col("dt") == F.lit(days[-1]))
    sales = spark.read.parquet(wh.table("sales"))
    per_customer = sales.groupBy("o_custkey").agg(
        F.min("dt").alias("first_day"), F.max("dt").alias("last_day"), F.count("*").alias("lines"), F.sum("net").alias("net_sales")
    )
    assert sorted(map(str, totals.drop("dt").collect())) == sorted(map(str, per_customer.select(totals.drop("dt").columns).collect()))

    with pytest.raises(ValueError):
        run_day(wh, days[0], days[1])


def test_late_and_early_lines_are_not_lost(spark, folder, days):
    """Lines land on the day of their order, a day before it or a day after it."""
    plain = warehouse(spark, folder, days).source
    shift = (F.col("l_linenumber") % 3 - 1).cast("int")

    def source(name, day):
        if name != "lineitem":
            return plain(name, day)
        orders = plain("orders", day).select("o_orderkey", F.to_date("o_orderdate").alias("d"))
        lines = plain("lineitem", day).join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        lands = F.greatest(F.date_add("d", shift), F.lit(days[0]))
        return lines.where(lands == F.lit(day)).drop("o_orderkey", "d")

    wh = Warehouse(spark, source, work_folder(spark, "warehouse"), keep_late=True)
    more = [*days, days[-1] + timedelta(days=1)]

    def balance(upto):
        landed = sum(source("lineitem", d).count() for d in more if d <= upto)
        kept = sum(spark.read.parquet(wh.table(t)).where(F.col("dt") <= F.lit(upto)).count() for t in ("sales", "rejects"))
        waiting = spark.read.parquet(wh.table("pending")).where(F.col("dt") == F.lit(upto)).count()
        assert landed == kept + waiting
        return waiting

    run_days(wh, more[:2])
    assert balance(more[1]) > 0
    run_days(wh, more[2:], more[1])
    assert balance(more[-1]) == 0
    everything = read_table(spark, folder, "lineitem").count()
    assert sum(spark.read.parquet(wh.table(t)).count() for t in ("sales", "rejects")) == everything
    run_day(wh, more[-1], more[-2])
    assert balance(more[-1]) == 0


@pytest.mark.parametrize("ties", ["rank", "dense_rank"])
def test_levels_are_cut_for_any_k(spark, ties):
    df = spark.range(9000).selectExpr("id % 1 AS g", "id % 4000 AS x")
    top = topk_per_group(df, ["g"], "x", 2000, ties)
    # Spark cuts below the shuffle; beyond its threshold lanes do.
    assert re.search(r"WindowGroupLimit.*Final.*Exchange.*WindowGroupLimit.*Partial", plan_of(top), re.S)
    assert "__lane" not in plan_of(top) and "__lane" in plan_of(topk_per_group(df, ["g"], "x", 200_000, ties))
    rows = [(r.x, r.place) for r in top.collect()]
    kept = sorted((x for x in [n % 4000 for n in range(9000)]), reverse=True)
    if ties == "rank":
        expected = [(x, 1 + kept.index(x)) for x in kept if kept.index(x) < 2000]
    else:
        expected = [(x, 4000 - x) for x in kept if 4000 - x <= 2000]
    assert sorted(rows) == sorted(expected)


def test_reconcile_uses_hash_aggregates(spark):
    from dayfold.operators import reconcile

    df = spark.range(5).selectExpr("id", "id AS x", "'t' AS y")
    assert "SortAggregate" not in plan_of(reconcile(df, df, ["id"]))


@pytest.fixture
def merged(spark):
    """Many shuffle partitions, which AQE merges as far as the size allows, whatever the number of cores."""
    given = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false"}
    before = {name: spark.conf.get(name) for name in given}
    for name, value in given.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def rows_by_task(df, column):
    tasks = df.select(F.spark_partition_id().alias("task"), column)
    return [n for _, n in tasks.groupBy("task").agg(F.count(column)).collect()]


def test_merged_partitions_stay_small(spark, merged):
    """AQE merges shuffle partitions to a few megabytes a task, as sorts and hash maps take many times that."""
    rows = spark.range(2_000_000).select(F.xxhash64("id").alias("k"), F.xxhash64("id", F.lit(1)).alias("v"))
    counts = rows_by_task(rows.groupBy("k").agg(F.max("v").alias("v")), "v")
    assert sum(counts) == 2_000_000 and max(counts) < 600_000


def test_lookup_tasks_stay_small(spark, merged):
    """The join of facts with a large history is dealt over tasks of a few megabytes each."""
    rows = spark.range(1_000_000).select(
        F.xxhash64("id").alias("k"), F.xxhash64("id", F.lit(1)).alias("v"), F.timestamp_seconds("id").alias("ts")
    )
    history = rows.select("k", "v", F.lit(0).cast("timestamp").alias("valid_from"), F.lit(9e9).cast("timestamp").alias("valid_to"))
    found = scd2_lookup(rows.drop("v"), history, {"k": "k"}, "ts", {"v": "v"}, small=False)
    counts = rows_by_task(found, "v")
    assert sum(counts) == 1_000_000 and max(counts) < 500_000
