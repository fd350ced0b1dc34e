import math
import random
import statistics
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from dayfold.functions.hot import HotSplit
from dayfold.operators.summaries import (
    active_ids,
    daily_summary,
    distinct_sketch,
    grouping_summary,
    merge_sketch,
    period_to_date,
    pivot_summary,
    quantile_summary,
    to_date_merge,
    trailing_summary,
    unpivot_summary,
)

FIRST = date(2024, 1, 1)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_daily_and_trailing(spark):
    data = [("a", datetime(2024, 1, d, 5), d) for d in (1, 2, 2, 3, 9, 10)] + [("b", datetime(2024, 1, 3), None)]
    df = spark.createDataFrame(data, "k string, ts timestamp_ntz, v int")
    measures = {"n": ("count", "1"), "total": ("sum", "v"), "top": ("max", F.col("v") + 1)}
    daily = daily_summary(df, ["k"], "ts", measures)
    assert ("a", date(2024, 1, 2), 2, 4, 3) in rows(daily)
    assert ("b", date(2024, 1, 3), 1, None, None) in rows(daily)
    assert rows(trailing_summary(daily, ["k"], "2024-01-10", measures, (1, 2, 8))) == [
        ("a", 1, 1, 10, 11),
        ("a", 2, 2, 19, 11),
        ("a", 8, 3, 22, 11),
        ("b", 8, 1, None, None),
    ]


def test_to_date_fold_equals_one_pass(spark):
    rnd = random.Random(1)
    data = [(rnd.randrange(5), FIRST + timedelta(days=d), Decimal(rnd.randrange(1000)) / 100) for d in range(6) for _ in range(4)]
    daily = (
        spark.createDataFrame(data, "k int, dt date, v decimal(18,2)")
        .groupBy("k", "dt")
        .agg(F.sum("v").cast("decimal(18,2)").alias("v"))
    )
    state = None
    for d in range(6):
        state = to_date_merge(state, daily.where(F.col("dt") == F.lit(FIRST + timedelta(days=d))), ["k"], ["v"])
    assert rows(state) == rows(to_date_merge(None, daily, ["k"], ["v"]))
    with pytest.raises(Exception, match="day already merged"):
        to_date_merge(state, daily.where(F.col("dt") == F.lit(FIRST)), ["k"], ["v"]).collect()


def test_period_to_date_starts_over(spark):
    data = [("a", date(2024, 1, 31), 1), ("a", date(2024, 2, 1), 2), ("a", date(2024, 2, 29), 3), ("a", date(2025, 2, 1), 4)]
    df = spark.createDataFrame(data, "k string, dt date, v int")
    out = {r.dt: r.v_month_to_date for r in period_to_date(df, ["k"], "month", ["v"]).collect()}
    assert list(out.values()) == [1, 2, 5, 4]
    year = {r.dt: r.v_year_to_date for r in period_to_date(df, ["k"], "year", ["v"]).collect()}
    assert list(year.values()) == [1, 3, 6, 4]


def test_grouping_id_tells_nulls_from_subtotals(spark):
    df = spark.createDataFrame([("a", None, 1), ("a", "x", 2), (None, "x", 4)], "p string, q string, v int")
    out = rows(grouping_summary(df, ["p", "q"], "rollup", {"v": ("sum", "v"), "low": ("min", "v")}))
    assert ("a", None, 0, 1, 1) in out and ("a", None, 1, 3, 1) in out
    assert (None, None, 1, 4, 4) in out and (None, None, 3, 7, 1) in out
    sets = grouping_summary(df, ["p", "q"], "sets", {"v": ("sum", "v")}, [["q"], []])
    assert rows(sets) == sorted([(None, None, 2, 1), (None, "x", 2, 6), (None, None, 3, 7)], key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_active_ids(spark, seed):
    rnd = random.Random(seed)
    data = [(rnd.choice([1, 1, 2, 3, 4, None]), FIRST + timedelta(days=rnd.randrange(60))) for _ in range(60)]
    df = spark.createDataFrame([(i, datetime(d.year, d.month, d.day, 7)) for i, d in data], "id int, ts timestamp_ntz")
    start, end = FIRST + timedelta(days=20), FIRST + timedelta(days=70)
    expected = []
    for n in (1, 3, 10):
        for k in range((end - start).days + 1):
            day = start + timedelta(days=k)
            ids = {i for i, d in data if i is not None and day - timedelta(days=n) < d <= day}
            expected.append((n, day, len(ids)))
    assert rows(active_ids(df, "id", "ts", start, end, [1, 3, 10])) == sorted(expected, key=str)


def test_sketches_merge_within_their_error(spark):
    df = spark.range(60_000).select(
        (F.col("id") % 20_000).alias("user"),
        F.timestamp_seconds(F.col("id") * 40).cast("timestamp_ntz").alias("ts"),
    )
    daily = distinct_sketch(df, "user", "ts")
    assert daily.count() > 20
    estimate = merge_sketch(daily, []).first().approx_ids
    # Three standard errors at 2**12 buckets.
    assert abs(estimate - 20_000) < 20_000 * 3 * 1.04 / 64


@pytest.mark.parametrize("split", [HotSplit(), HotSplit(min_rows=3, rows_per_cell=2)])
@pytest.mark.parametrize("kind", ["double", "decimal(10,2)", "date", "int"])
def test_exact_quantiles(spark, split, kind):
    rnd = random.Random(5)
    values = [(rnd.choice(["a", "a", "a", "b", None]), rnd.choice([rnd.randrange(50), 7, None])) for _ in range(300)]
    df = spark.createDataFrame(values, "g string, v int")
    column = F.date_add(F.lit(FIRST), F.col("v")) if kind == "date" else F.col("v").cast(kind)
    df = df.withColumn("v", column)
    names = {"low": 0, "p10": 0.1, "p50": 0.5, "p99": 0.99, "high": 1}

    def pick(data, q):
        return sorted(data)[max(math.ceil(len(data) * Decimal(str(q))) - 1, 0)]

    groups = {g: [v for k, v in values if k == g and v is not None] for g in ("a", "b", None)}
    found = {r.g: r for r in quantile_summary(df, ["g"], "v", names, "discrete", split=split).collect()}
    for g, data in groups.items():
        for name, q in names.items():
            want = pick(data, q)
            assert found[g][name] == (FIRST + timedelta(days=want) if kind == "date" else want)
    overall = quantile_summary(df, [], "v", {"p50": 0.5}, "discrete", split=split).collect()
    assert len(overall) == 1
    if kind == "date":
        return
    found = {r.g: r for r in quantile_summary(df, ["g"], "v", {"p50": 0.5, "p30": 0.3}, split=split).collect()}
    for g, data in groups.items():
        assert found[g].p50 == statistics.median(data)
        at = (len(data) - 1) * 0.3
        low, high = sorted(data)[int(at)], sorted(data)[min(int(at) + 1, len(data) - 1)]
        assert abs(found[g].p30 - (low + (high - low) * (at - int(at)))) < 1e-9


def test_quantiles_of_odd_doubles(spark):
    data = [float("nan"), float("inf"), float("-inf"), 1.0, 2.0, -0.0, 0.0]
    df = spark.createDataFrame([(v,) for v in data], "v double")
    split = HotSplit(min_rows=2, rows_per_cell=1)
    out = quantile_summary(df, [], "v", {"low": 0, "zero": 0.3, "mid": 0.5, "high": 0.8}, "discrete", split=split)
    assert tuple(out.first()) == (float("-inf"), 0.0, 1.0, float("inf"))


def test_approximate_quantiles_are_close(spark):
    df = spark.range(100_001).select(F.col("id").cast("double").alias("v"))
    out = quantile_summary(df, [], "v", {"p50": 0.5}, "approx", accuracy=1000).first()
    assert abs(out.p50 - 50_000) <= 100


def test_pivot_and_back(spark):
    data = [("r1", "a", 1), ("r1", "a", 2), ("r1", "b", 5), ("r2", "c", 7), ("r3", "a", None), (None, "a", 3)]
    df = spark.createDataFrame(data, "r string, c string, v int")
    wide = pivot_summary(df, ["r"], "c", ["a", "b"], ("sum", "v"))
    assert rows(wide) == sorted([("r1", 3, 5), ("r2", None, None), ("r3", None, None), (None, 3, None)], key=str)
    back = unpivot_summary(wide, ["r"], ["a", "b"], "c", "v")
    assert rows(back) == sorted([("r1", "a", 3), ("r1", "b", 5), (None, "a", 3)], key=str)


def test_bitmaps_give_the_active_ids(spark):
    from dayfold.operators import active_bitmaps, active_ids, merge_bitmaps

    events = spark.range(4000).selectExpr(
        "CASE WHEN id % 97 = 0 THEN NULL WHEN id % 5 = 0 THEN -id * 99991 ELSE id % 300 * 40000 END AS user",
        "timestamp_ntz'2024-02-20' + make_dt_interval(CAST(id * id % 23 AS int), CAST(id % 24 AS int)) AS ts",
    ).where("to_date(ts) NOT IN ('2024-02-26', '2024-02-27')")
    days = date(2024, 2, 18), date(2024, 3, 20)
    stored = active_bitmaps(events, "user", "ts")
    assert stored.columns == ["dt", "bucket", "bitmap"]
    found = rows(merge_bitmaps(stored, *days, (1, 3, 30)).select("span_days", "dt", "active_ids"))
    assert found == rows(active_ids(events, "user", "ts", *days, (1, 3, 30)).select("span_days", "dt", "active_ids"))
    assert len(found) == 3 * 32 and max(r[2] for r in found) > 500
    none = merge_bitmaps(active_bitmaps(events.where("false"), "user", "ts"), *days, (2,))
    assert {r.active_ids for r in none.collect()} == {0}
    with pytest.raises(TypeError, match="whole numbers"):
        active_bitmaps(events.withColumn("user", F.lit("x")), "user", "ts")


def test_merged_quantile_sketches_are_within_their_bound(spark):
    from dayfold.operators import merge_quantiles, quantile_sketch

    df = spark.range(60_000).selectExpr(
        "id % 2 AS g",
        "CASE WHEN id % 50 = 0 THEN NULL WHEN id % 51 = 0 THEN double('NaN') ELSE pow(id * 7919 % 60000, 2) END AS x",
        "timestamp_ntz'2024-01-01' + make_dt_interval(CAST(id % 40 AS int)) AS ts",
    )
    wanted = {"low": 0.0, "p10": 0.1, "p50": 0.5, "p99": 0.99, "high": 1.0}
    daily = quantile_sketch(df, "x", "ts", ["g"])
    assert daily.count() == 40
    for r in merge_quantiles(daily, ["g"], wanted).collect():
        values = sorted(v.x for v in df.where(f"g = {r.g} AND x IS NOT NULL AND NOT isnan(x)").collect())
        assert r.n == len(values)
        for name, q in wanted.items():
            rank = sum(v <= r[name] for v in values) / len(values)
            assert abs(rank - q) < 0.02, (name, rank)
    assert merge_quantiles(daily.where("false"), ["g"], wanted).collect() == []
