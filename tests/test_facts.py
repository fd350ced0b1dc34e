import random
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from dayfold.functions.hot import HotSplit
from dayfold.operators.facts import accumulating_snapshot, allocate_header_amount, periodic_snapshot
from dayfold.operators.sequence import asof_join, next_event, sessionize

SPLITS = [HotSplit(), HotSplit(min_rows=3, rows_per_cell=2), HotSplit(min_rows=20, rows_per_cell=15)]
START = datetime(2024, 1, 1)
GAP = timedelta(minutes=30)


def random_activity(seed, n=400):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        user = rnd.choice([9, 9, 9, 9, 1, 2, None])
        # Bursts, repeated times and some events without a time.
        ts = START + timedelta(minutes=rnd.choice([10, 10, 15]) * rnd.randrange(200), microseconds=rnd.randrange(2))
        out.append((i, user, None if rnd.random() < 0.02 else ts, rnd.choice("abc")))
    return out


def by_user(activity):
    users = {}
    for row in activity:
        if row[2] is not None:
            users.setdefault(row[1], []).append(row)
    return {u: sorted(r, key=lambda e: (e[2], e[0])) for u, r in users.items()}


@pytest.mark.parametrize("split", SPLITS)
@pytest.mark.parametrize("seed", [1, 2, 3])
def test_sessionize(spark, split, seed):
    activity = random_activity(seed)
    expected = {row[0]: None for row in activity}
    for events in by_user(activity).values():
        number, last = 0, None
        for event in events:
            number += last is None or event[2] - last > GAP
            expected[event[0]], last = number, event[2]
    df = spark.createDataFrame(activity, "id int, user int, ts timestamp_ntz, kind string")
    out = sessionize(df, "user", "ts", GAP, split=split)
    assert out.columns == [*df.columns, "session_no"]
    assert {r.id: r.session_no for r in out.collect()} == expected


def test_a_wait_equal_to_the_gap_does_not_open_a_session(spark):
    later = START + GAP
    rows = [(1, START), (1, later), (1, later + GAP + timedelta(microseconds=1))]
    df = spark.createDataFrame(rows, "user int, ts timestamp_ntz")
    assert sorted(r.session_no for r in sessionize(df, "user", "ts", GAP).collect()) == [1, 1, 2]


@pytest.mark.parametrize("split", SPLITS)
def test_next_event(spark, split):
    activity = [a for a in random_activity(4) if a[2] is not None]
    expected = {}
    for events in by_user(activity).values():
        for event, following in zip(events, [*events[1:], None]):
            expected[event[0]] = following and (following[2], following[3])
    df = spark.createDataFrame(activity, "id int, user int, ts timestamp_ntz, kind string")
    out = next_event(df, "user", "ts", ["kind"], ["id"], split=split).collect()
    assert {r.id: r.next and (r.next.ts, r.next.kind) for r in out} == expected


@pytest.mark.parametrize("split", SPLITS)
@pytest.mark.parametrize("seed", [5, 6])
def test_asof_join(spark, split, seed):
    left, right = random_activity(seed, 200), random_activity(seed + 100, 200)
    schema = "id int, user int, ts timestamp_ntz, kind string"
    out = asof_join(
        spark.createDataFrame(left, schema), spark.createDataFrame(right, schema), ["user"], "ts", ["id"], split=split
    )
    assert out.columns == ["id", "user", "ts", "kind", "id_right", "ts_right", "kind_right"]
    found = {r.id: r.id_right for r in out.collect()}
    assert len(found) == out.count() == 200
    known = by_user(right)
    for i, user, ts, _ in left:
        before = [e for e in known.get(user, []) if user is not None and ts is not None and e[2] <= ts]
        assert found[i] == (before[-1][0] if before else None)


def test_accumulating_snapshot(spark):
    rows = [
        (1, START, "open"),
        (1, START + timedelta(hours=2), "pay"),
        (1, START + timedelta(hours=1), "pay"),
        (2, START, "pay"),
    ]
    df = spark.createDataFrame(rows, "id int, ts timestamp_ntz, kind string")
    out = {r.id: r for r in accumulating_snapshot(df, "id", "ts", "kind", ["open", "pay", "ship"]).collect()}
    assert out[1].hours_open_to_pay == 1.0 and out[1].ship_at is None and out[1].hours_pay_to_ship is None
    assert out[2].open_at is None and out[2].hours_open_to_pay is None


def test_periodic_snapshot(spark):
    rows = [
        (1, "a", datetime(2024, 1, 1), datetime(2024, 1, 3)),
        (1, "b", datetime(2024, 1, 3), datetime(2024, 1, 3, 12)),
        (1, "c", datetime(2024, 1, 3, 12), datetime(9999, 12, 31)),
        (2, "z", datetime(2024, 2, 1), datetime(9999, 12, 31)),
    ]
    df = spark.createDataFrame(rows, "k int, v string, valid_from timestamp_ntz, valid_to timestamp_ntz")
    out = [tuple(r) for r in periodic_snapshot(df, "2024-01-02", "2024-01-05").orderBy("dt").collect()]
    assert out == [
        (1, "a", date(2024, 1, 2)),
        (1, "c", date(2024, 1, 3)),
        (1, "c", date(2024, 1, 4)),
        (1, "c", date(2024, 1, 5)),
    ]


@pytest.mark.parametrize("split", SPLITS)
def test_allocation_adds_up(spark, split):
    d = Decimal
    header = [(1, d("10.00")), (2, d("5.00")), (3, d("7.77")), (4, d("1.00")), (5, d("-0.05")), (6, d("9999.99"))]
    lines = [(1, n, d("1.00")) for n in range(3)]
    lines += [(2, 0, d("0.00")), (2, 1, d("0.00")), (3, 0, d("4.20")), (5, 0, d("1.00")), (5, 1, d("2.00")), (5, 2, None)]
    rnd = random.Random(1)
    lines += [(6, n, d(rnd.randrange(1, 9999)) / 100) for n in range(60)]
    shared, without, _ = allocate_header_amount(
        spark.createDataFrame(lines, "h bigint, n int, weight decimal(18,2)"),
        spark.createDataFrame(header, "h bigint, amount decimal(18,2)"),
        "h", "amount", "weight", ["n"], split=split,
    )
    rows = {(r.h, r.n): r.allocated for r in shared.collect()}
    assert len(rows) == len(lines)
    amounts = dict(header)
    for h in (1, 2, 3, 5, 6):
        assert sum(v for (k, _), v in rows.items() if k == h) == amounts[h]
    assert [rows[1, n] for n in range(3)] == [d("3.33"), d("3.33"), d("3.34")]
    assert [rows[2, n] for n in range(2)] == [d("0.00"), d("5.00")]
    assert [rows[5, n] for n in range(3)] == [d("-0.02"), d("-0.03"), d("0.00")]
    assert [r.h for r in without.collect()] == [4]


def ranges_of(df, keys, order, split):
    from dayfold.functions.hot import CELL, find_hot

    hot = find_hot(df, keys, split)
    return hot, hot.in_ranges(hot.only(df), order).withColumnRenamed(CELL, "cell")


def test_hot_rows_are_dealt_over_ranges(spark):
    df = spark.createDataFrame([(i % 5 != 0, i) for i in range(1000)], "k boolean, x int")
    hot, ranges = ranges_of(df, ["k"], ["x"], HotSplit(min_rows=500, rows_per_cell=100))
    per_cell = ranges.groupBy("cell").agg(F.count("*").alias("n"), F.min("x").alias("a"), F.max("x").alias("b"))
    found = per_cell.orderBy("cell").collect()
    assert sum(r.n for r in found) == 800 and hot.rest(df).count() == 200
    assert max(r.n for r in found) <= 200 and len(found) >= 7
    assert all(x.b < y.a for x, y in zip(found, found[1:]))


@pytest.mark.parametrize("stray", ["1e12", "-1e12", "CAST('Infinity' AS DOUBLE)", "CAST(NULL AS DOUBLE)"])
def test_bursts_strays_and_piles_do_not_undo_the_split(spark, stray):
    """Nearly all rows lie within one of 256 parts of the span, and a third of them at one instant."""
    x = "CASE WHEN id % 3 = 0 THEN 77.5 ELSE pow(id % 1000, 2) / 1e6 END"
    df = spark.range(20_000).selectExpr("1 AS k", f"{x} AS x", "id").unionAll(spark.sql(f"SELECT 1, {stray}, -1"))
    for keys in (["k"], []):
        _, ranges = ranges_of(df, keys, ["x"], HotSplit(min_rows=500, rows_per_cell=200))
        found = ranges.groupBy("cell").agg(F.count("*").alias("n"), F.min("x").alias("a"), F.max("x").alias("b"))
        found = found.orderBy("cell").collect()
        assert sum(r.n for r in found) == 20_001 and max(r.n for r in found) <= 1000
        known = [r for r in found if r.a is not None]
        assert all(x.b <= y.a for x, y in zip(known, known[1:]))


def test_text_is_split_and_no_hot_group_gives_the_plain_plan(spark):
    from dayfold.functions.hot import NO_SPLIT, find_hot

    df = spark.range(30_000).selectExpr("id % 1000 AS k", "id AS x", "CAST(id AS string) AS t")
    _, ranges = ranges_of(df, ["k"], ["t"], HotSplit(min_rows=20, rows_per_cell=1000))
    assert ranges.groupBy("cell").count().agg(F.max("count")).first()[0] <= 5000
    assert find_hot(df, ["k"], HotSplit(min_rows=30)) is None and find_hot(df, [], NO_SPLIT) is None


def test_a_pile_at_one_instant(spark):
    """Most rows of one user have one time; numbers, next events and matches are as without a split."""
    rows = spark.range(3000).selectExpr(
        "id", "id % 50 = 0 AS user", "timestamp_ntz'2024-01-01' + make_interval(0,0,0,0,0,0, CASE WHEN id % 4 = 0 THEN id ELSE 700 END) AS ts"
    )
    some = rows.where("id % 40 = 3").withColumnRenamed("id", "mark")
    split = HotSplit(min_rows=50, rows_per_cell=40)
    gap = timedelta(seconds=6)
    for of in (
        lambda s: sessionize(rows, "user", "ts", gap, split=s),
        lambda s: next_event(rows, "user", "ts", ["id"], ["id"], split=s),
        lambda s: asof_join(rows, some, ["user"], "ts", ["mark"], split=s),
        lambda s: asof_join(some, rows, ["user"], "ts", ["id"], split=s),
    ):
        assert sorted(map(str, of(split).collect())) == sorted(map(str, of(HotSplit()).collect()))


@pytest.mark.parametrize("split", SPLITS)
def test_allocation_of_ties_orphans_and_repeated_headers(spark, split):
    header = spark.createDataFrame([(1, 100.0), (2, 5.0)], "h int, amount double")
    lines = spark.createDataFrame([(1, 1.0)] * 3 + [(9, 1.0)] * 4 + [(None, 1.0)], "h int, w double")
    shared, without, orphans = allocate_header_amount(lines, header, "h", "amount", "w", ["w"], split=split)
    assert sorted(r.allocated for r in shared.collect()) == [Decimal("33.33"), Decimal("33.33"), Decimal("33.34")]
    assert [r.h for r in without.collect()] == [2]
    assert sorted([r.h for r in orphans.collect()], key=str) == [9, 9, 9, 9, None]
    twice = header.union(header.where("h = 1"))
    with pytest.raises(Exception, match="header key occurs twice"):
        allocate_header_amount(lines, twice, "h", "amount", "w", ["w"], split=split)[0].collect()


def copies(spark, n):
    """One event ``n`` times, and a few others of the same user."""
    schema = "id int, user int, ts timestamp_ntz"
    others = spark.createDataFrame([(i, 1, START + timedelta(hours=i)) for i in range(1, 5)], schema)
    same = spark.range(n).selectExpr("0 AS id", "1 AS user", "timestamp_ntz'2024-01-01 02:30:00' AS ts")
    return others.union(same)


@pytest.mark.parametrize("split", [HotSplit(), HotSplit(min_rows=50, rows_per_cell=10)])
def test_copies_of_one_event(spark, split):
    df = copies(spark, 500)
    sessions = sessionize(df, "user", "ts", timedelta(minutes=45), split=split)
    counts = {r.session_no: r["count"] for r in sessions.groupBy("session_no").count().collect()}
    assert counts == {1: 1, 2: 502, 3: 1}
    out = asof_join(df, df.where("id > 0"), ["user"], "ts", split=split).groupBy("id", "id_right").count()
    assert {(r.id, r.id_right): r["count"] for r in out.collect()} == {(0, 2): 500, **{(i, i): 1 for i in range(1, 5)}}
    out = asof_join(df.where("id > 0"), df, ["user"], "ts", ["id"], split=split)
    assert {r.id: r.id_right for r in out.collect()} == {1: 1, 2: 2, 3: 3, 4: 4}
    late = df.where("id = 1").withColumn("ts", F.expr("ts + INTERVAL '100' MINUTES"))
    assert asof_join(late, df, ["user"], "ts", ["id"], split=split).first().id_right == 0


def test_no_split_needs_no_first_pass(spark):
    from dayfold.functions.hot import NO_SPLIT

    df = copies(spark, 5)
    plan = sessionize(df, "user", "ts", GAP, split=NO_SPLIT)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_long_lists_of_hot_groups_are_not_broadcast(spark, monkeypatch):
    from dayfold.functions import hot

    monkeypatch.setattr(hot, "MOST_BROADCAST", 10)
    df = spark.range(600).selectExpr("id % 100 AS k", "id")
    groups = hot.HotGroups(df, ["k"], HotSplit(min_rows=3, rows_per_cell=2))
    totals = df.groupBy("k").agg(F.count("*").alias("n"))
    for out in (groups.only(df), groups.rest(df), groups.lanes(df, "lane"), groups.with_totals(df, totals, "k")):
        out.collect()
        assert "Broadcast" not in out._jdf.queryExecution().executedPlan().toString()
    assert groups.only(df).count() == 600 and groups.rest(df).isEmpty()
