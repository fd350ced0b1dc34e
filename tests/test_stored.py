"""Tables in buckets of their key, the daily headers, and tables deleted after use."""

import re
from datetime import date, datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from dayfold.operators import latest_by_key, scd1_upsert, scd2_build
from dayfold.operators.stored import scd2_apply_stored, stored_history, upsert_stored
from dayfold.plans.daily import Warehouse, _headers_of, run_days
from dayfold.session import tidy, work_folder, written
from dayfold.sources.buckets import BUCKET, BucketStore, bucket_of

KEYS = ["key"]


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def files(store):
    """The data files of each bucket."""
    found = {}
    for p in Path(store.path).glob(f"{BUCKET}=*/*.parquet"):
        found.setdefault(int(p.parent.name.split("=")[1]), set()).add(p.name)
    return found


def in_bucket(spark, n, buckets=16, of=4000):
    keys = spark.range(of).select(F.col("id").alias("key"))
    return keys.where(bucket_of(KEYS, buckets) == n)


def test_upsert_rewrites_touched_buckets_alone(spark):
    current = spark.range(4000).selectExpr("IF(id = 7, NULL, id) AS key", "'old' AS x", "id AS y")
    store = BucketStore(spark, work_folder(spark, "store"), current.schema, KEYS, 16)
    store.replace(current)
    before = files(store)
    assert len(before) == 16 and rows(store.read()) == rows(current)
    # A hundredth of the keys, all in one bucket, and a new key there.
    changes = in_bucket(spark, 3).limit(40).selectExpr("key", "CAST(NULL AS string) AS x", "-1 AS y")
    changes = changes.unionByName(in_bucket(spark, 3, of=9000).where("key > 5000").limit(1).selectExpr("key", "'new' AS x", "0 AS y"))
    changes = written(changes, "changes")
    expected = rows(scd1_upsert(current, changes, KEYS))
    assert upsert_stored(store, changes) == [3]
    after = files(store)
    assert {n for n in after if after[n] != before[n]} == {3} and not after[3] & before[3]
    assert rows(store.read()) == expected and len(expected) == 4001
    # Once more gives the same; no changes touch nothing.
    upsert_stored(store, changes)
    assert rows(store.read()) == expected
    now = files(store)
    assert upsert_stored(store, changes.where("false")) == [] and files(store) == now
    # A NULL key has a bucket as well.
    null_key = spark.sql("SELECT CAST(NULL AS bigint) AS key, 'n' AS x, 1L AS y")
    upsert_stored(store, null_key)
    assert [r.x for r in store.read().where("key IS NULL").collect()] == ["n"]


def test_only_touched_buckets_are_read(spark):
    df = spark.range(500).withColumnRenamed("id", "key")
    store = BucketStore(spark, work_folder(spark, "store"), df.schema, KEYS, 8)
    assert store.read().count() == 0
    store.replace(df)
    part = store.read([2, 5])
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert re.search(rf"PartitionFilters: \[.*{BUCKET}.* IN \(2,5\)", plan)
    read = part.select(F.input_file_name().alias("f")).distinct().collect()
    assert {re.search(rf"{BUCKET}=(\d+)", r.f)[1] for r in read} == {"2", "5"}
    assert store.touched(df.where("key IN (1, 2, 3)")) == sorted(
        {r[0] for r in df.where("key IN (1, 2, 3)").select(bucket_of(KEYS, 8)).collect()}
    )


def test_stored_history_over_days_equals_build(spark):
    start = date(2024, 1, 1)
    days = [start + timedelta(days=n) for n in range(5)]
    # Every key changes on some days, to a value that sometimes is the one it has.
    changes = spark.range(600).selectExpr(
        "id % 97 AS key", "timestamp_ntz'2024-01-01' + make_dt_interval(CAST(id % 5 AS int)) AS ts", "id AS seq", "CAST(id * 7 % 3 AS string) AS attr"
    )
    built = scd2_build(changes, KEYS, "ts", ["attr"], ["seq"])
    store = BucketStore(spark, work_folder(spark, "open"), built.schema, KEYS, 8)
    closed = work_folder(spark, "closed")
    of_day = lambda d: latest_by_key(changes.where(F.to_date("ts") == F.lit(d)), KEYS, ["seq"])
    for day in days:
        scd2_apply_stored(store, closed, of_day(day), day, ["attr"])
    assert rows(stored_history(store, closed)) == rows(built)
    # A day again, and a day whose store was not yet written when it failed.
    scd2_apply_stored(store, closed, of_day(days[-1]), days[-1], ["attr"])
    assert rows(stored_history(store, closed)) == rows(built)
    # A day that changes the keys of one bucket leaves the files of all others.
    before = files(store)
    some = written(store.read([1]).select("key").withColumn("attr", F.lit("9")), "some")
    next_day = days[-1] + timedelta(days=1)
    assert scd2_apply_stored(store, closed, some, next_day, ["attr"]) == [1]
    after = files(store)
    assert {n for n in after if after[n] != before[n]} == {1}
    more = some.select("key", F.lit(datetime(2024, 1, 6)).cast("timestamp_ntz").alias("ts"), F.lit(999).alias("seq"), "attr")
    again = scd2_build(changes.unionByName(more), KEYS, "ts", ["attr"], ["seq"])
    assert rows(stored_history(store, closed)) == rows(again)


def test_a_failed_day_can_be_repeated(spark, monkeypatch):
    changes = spark.sql("SELECT 1L AS key, 'a' AS attr")
    schema = "key bigint, attr string, valid_from timestamp_ntz, valid_to timestamp_ntz, is_current boolean"
    store = BucketStore(spark, work_folder(spark, "open"), spark.createDataFrame([], schema).schema, KEYS, 4)
    closed = work_folder(spark, "closed")
    scd2_apply_stored(store, closed, changes, date(2024, 1, 1), ["attr"])
    second = changes.withColumn("attr", F.lit("b"))

    def fail(self, rows):
        raise OSError("disk full")

    with monkeypatch.context() as patch:
        patch.setattr(BucketStore, "replace", fail)
        with pytest.raises(OSError):
            scd2_apply_stored(store, closed, second, date(2024, 1, 2), ["attr"])
    for _ in range(2):
        scd2_apply_stored(store, closed, second, date(2024, 1, 2), ["attr"])
        found = [(r.attr, r.valid_from, r.is_current) for r in stored_history(store, closed).collect()]
        assert sorted(found) == [("a", datetime(2024, 1, 1), False), ("b", datetime(2024, 1, 2), True)]


DAYS = [date(2024, 1, d) for d in (1, 2, 3)]


def small_warehouse(spark, orders, lines):
    def source(name, day):
        at = F.col("landed") == F.lit(day)
        if name == "orders":
            rows = spark.createDataFrame(orders, "landed date, o_orderkey bigint, o_custkey bigint, o_orderpriority string")
            return rows.where(at).select("o_orderkey", "o_custkey", "o_orderpriority", F.lit(day).cast("timestamp_ntz").alias("o_orderdate"))
        if name == "lineitem":
            schema = "landed date, l_orderkey bigint, l_linenumber int"
            priced = spark.createDataFrame(lines, schema).where(at).drop("landed")
            return priced.selectExpr("*", "1.0D AS l_quantity", "0.05D AS l_discount", "10.0D AS l_extendedprice")
        empty = {
            "customer": "c_custkey bigint, c_nationkey int",
            "nation": "n_nationkey int, n_regionkey int",
            "region": "r_regionkey int, r_name string",
        }
        return spark.createDataFrame([], empty[name])

    return Warehouse(spark, source, work_folder(spark, "warehouse"), keep_late=True)


def test_orders_that_land_again_sell_each_line_once(spark):
    first, second, third = DAYS
    orders = [
        (first, 1, 10, "a"), (second, 1, 11, "b"), (second, 2, 12, "a"), (second, 2, 13, "c"), (third, 3, 14, "a"), (third, 1, 15, "z"),
    ]
    lines = [
        (first, 1, 1), (second, 1, 2), (second, 2, 1), (third, 1, 3), (first, 3, 1), (second, 3, 2), (third, 9, 1), (third, 2, 2),
    ]
    wh = small_warehouse(spark, orders, lines)
    shared = Path(spark.conf.get("spark.checkpoint.dir"))
    before = {p.name for p in shared.iterdir()}
    run_days(wh, DAYS)
    left = {p.name for p in shared.iterdir()} - before
    assert all(name.startswith("warehouse-") for name in left), left
    sales = spark.read.parquet(wh.table("sales")).select("l_orderkey", "l_linenumber", "o_custkey", "dt")
    assert rows(sales) == sorted(
        [
            (1, 1, 10, first), (1, 2, 11, second), (2, 1, 13, second), (1, 3, 15, third),
            (3, 1, 14, third), (3, 2, 14, third), (2, 2, 13, third),
        ],
        key=str,
    )
    waiting = spark.read.parquet(wh.table("pending")).where(F.col("dt") == F.lit(third))
    assert [r.l_orderkey for r in waiting.collect()] == [9]
    # Lines of other orders read the headers in the buckets of their orders alone.
    some = spark.createDataFrame([(1,), (2,)], "l_orderkey bigint")
    like = spark.read.parquet(wh.table("headers")).select("o_orderkey", "o_custkey", "o_orderdate")
    found = _headers_of(wh, some, like, third)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert re.search(rf"PartitionFilters: \[.*{BUCKET}.* IN \(", plan)
    assert rows(found.select("o_orderkey", "o_custkey")) == [(1, 11), (2, 13)]


def test_tidy_deletes_what_was_written_within(spark):
    shared = Path(spark.conf.get("spark.checkpoint.dir"))
    kept = written(spark.range(3), "kept")
    with tidy():
        with tidy():
            inner = written(spark.range(4), "inner")
            assert inner.count() == 4
        outer = written(spark.range(5), "outer")
        assert outer.count() == 5
    names = {p.name.rsplit("-", 1)[0] for p in shared.iterdir()}
    assert "kept" in names and not names & {"inner", "outer"} and kept.count() == 3
