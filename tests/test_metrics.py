import random
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest

from dayfold.functions.hot import HotSplit
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

START = datetime(2024, 1, 1)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def activity(spark):
    months = {1: [1, 2, 4], 2: [2, 3], 3: [1, 4], None: [1]}
    data = [(i, datetime(2024, m, d)) for i, ms in months.items() for m in ms for d in (3, 20)]
    return spark.createDataFrame([*data, (5, None)], "id int, ts timestamp_ntz")


def test_new_ids(activity):
    assert rows(new_ids(activity, "id", "ts", "month")) == [(date(2024, 1, 1), 2), (date(2024, 2, 1), 1)]


def test_retention(activity):
    jan, feb = date(2024, 1, 1), date(2024, 2, 1)
    assert rows(retention_matrix(activity, "id", "ts")) == [
        (jan, 0, 2, 1.0),
        (jan, 1, 1, 0.5),
        (jan, 3, 2, 1.0),
        (feb, 0, 1, 1.0),
        (feb, 1, 1, 1.0),
    ]


def test_lifecycle(activity):
    assert rows(lifecycle(activity, "id", "ts")) == [
        (date(2024, 1, 1), 2, 0, 0, 0),
        (date(2024, 2, 1), 1, 1, 0, 1),
        (date(2024, 3, 1), 0, 1, 0, 1),
        (date(2024, 4, 1), 0, 0, 2, 1),
    ]


def test_streaks_across_a_month_end(spark):
    days = [date(2024, 1, 30), date(2024, 1, 31), date(2024, 1, 31), date(2024, 2, 1), date(2024, 2, 3)]
    df = spark.createDataFrame([(1, datetime(d.year, d.month, d.day, 9)) for d in days], "id int, ts timestamp_ntz")
    assert rows(streaks(df, "id", "ts")) == [
        (1, date(2024, 1, 30), date(2024, 2, 1), 3),
        (1, date(2024, 2, 3), date(2024, 2, 3), 1),
    ]


@pytest.mark.parametrize("split", [HotSplit(), HotSplit(min_rows=2)])
def test_funnel(spark, split):
    def at(hours):
        return START + timedelta(hours=hours)

    events = [
        (1, at(-1), "b"), (1, at(0), "a"), (1, at(1), "b"), (1, at(24), "c"),  # exactly at the end
        (2, at(0), "a"), (2, at(0), "b"), (2, at(24) + timedelta(microseconds=1), "b"),  # equal time, too late
        (3, at(0), "b"), (3, at(1), "c"),  # never step one
        (4, at(0), "a"), (4, at(2), "c"), (4, at(3), "b"),  # out of order
        (None, at(0), "a"),
    ]
    df = spark.createDataFrame(events, "id int, ts timestamp_ntz, kind string")
    out = rows(funnel(df, "id", "ts", "kind", ["a", "b", "c"], timedelta(hours=24), split))
    assert out == [(1, "a", 3), (2, "b", 2), (3, "c", 1)]


def test_funnel_with_piles_at_one_instant(spark):
    """An id with thousands of copies of each event, and many ids with few; no join gathers the pile."""
    few = spark.range(300).selectExpr("id % 60 + 2 AS id", "timestamp_ntz'2024-01-01' + make_dt_interval(0, CAST(id * 7 % 30 AS int)) AS ts", "CASE id % 3 WHEN 0 THEN 'a' WHEN 1 THEN 'b' ELSE 'c' END AS kind")
    pile = spark.range(6000).selectExpr("1L AS id", "timestamp_ntz'2024-01-01' + make_dt_interval(0, CAST(id % 3 AS int)) AS ts", "CASE id % 3 WHEN 0 THEN 'a' WHEN 1 THEN 'b' ELSE 'c' END AS kind")
    df = few.unionByName(pile)
    found = [
        rows(funnel(df, "id", "ts", "kind", ["a", "b", "c"], timedelta(hours=24), HotSplit(min_rows=n)))
        for n in (1, 100, 10**6)
    ]
    assert found[0] == found[1] == found[2] and found[0][0][2] > 20 and found[0][2][2] >= 1
    assert rows(funnel(pile, "id", "ts", "kind", ["a", "b", "c"], timedelta(hours=24), HotSplit(min_rows=10))) == [
        (1, "a", 1), (2, "b", 1), (3, "c", 1),
    ]


@pytest.mark.parametrize("ties", ["row", "rank", "dense_rank"])
def test_topk(spark, ties):
    rnd = random.Random(3)
    data = [(rnd.choice(["x", "y", None]), i, rnd.choice([1, 2, 3, 4, None])) for i in range(60)]
    df = spark.createDataFrame(data, "g string, id int, v int")
    expected = []
    for g in ("x", "y", None):
        group = sorted((r for r in data if r[0] == g), key=lambda r: (r[2] is None, -(r[2] or 0), r[1]))
        levels = []
        for place, r in enumerate(group, start=1):
            if not levels or levels[-1][0] != r[2]:
                levels.append((r[2], place))
            p = {"row": place, "rank": levels[-1][1], "dense_rank": len(levels)}[ties]
            if p <= 5:
                expected.append((*r, p))
    assert rows(topk_per_group(df, ["g"], "v", 5, ties, ["id"])) == sorted(expected, key=str)


def test_topk_with_a_large_k(spark):
    df = spark.range(3000).selectExpr("id % 2 AS g", "id AS v")
    out = topk_per_group(df, ["g"], "v", 1200)
    assert out.count() == 2400 and out.agg({"v": "min"}).first()[0] == 600
    assert out.columns == ["g", "v", "place"]


def test_growth_skips_no_gap(spark):
    data = [
        ("a", date(2023, 3, 1), Decimal(10)),
        ("a", date(2024, 1, 1), Decimal(20)),
        ("a", date(2024, 3, 1), Decimal(30)),
        ("a", date(2024, 4, 1), Decimal(45)),
        (None, date(2024, 4, 1), Decimal(0)),
        (None, date(2024, 5, 1), Decimal(1)),
    ]
    df = spark.createDataFrame(data, "k string, m date, v decimal(18,2)")
    out = {(r.k, r.m): r for r in period_growth(df, ["k"], "m", "month", "v").collect()}
    assert len(out) == len(data)
    march = out["a", date(2024, 3, 1)]
    assert (march.previous, march.last_year, march.growth, march.growth_on_year) == (None, 10, None, 2.0)
    assert out["a", date(2024, 4, 1)].growth == 0.5
    assert out[None, date(2024, 5, 1)].previous == 0 and out[None, date(2024, 5, 1)].growth is None


def test_growth_by_day_in_a_leap_year(spark):
    days = [date(2020, 2, 28), date(2020, 2, 29), date(2021, 2, 28), date(2021, 3, 1)]
    df = spark.createDataFrame([(d, i) for i, d in enumerate(days)], "d date, v int")
    out = {r.d: (r.previous, r.last_year) for r in period_growth(df, [], "d", "day", "v").collect()}
    assert out == {days[0]: (None, None), days[1]: (0, None), days[2]: (None, 0), days[3]: (2, None)}


def test_repeat_rate(spark):
    lines = [("b", 1, 10), ("b", 1, 10), ("b", 1, 11), ("b", 2, 12), ("c", 1, 10)]
    df = spark.createDataFrame(lines, "brand string, id int, ord int")
    assert rows(repeat_rate(df, ["brand"], "id", "ord")) == [("b", 2, 1, 0.5), ("c", 1, 0, 0.0)]


@pytest.mark.parametrize("split", [HotSplit(), HotSplit(min_rows=2, rows_per_cell=1)])
def test_transitions(spark, split):
    rnd = random.Random(9)
    data = [(i, rnd.choice([1, 1, 1, 2]), START + timedelta(minutes=10 * rnd.randrange(90)), rnd.choice("ab")) for i in range(120)]
    expected = {}
    for user in (1, 2):
        events = sorted((r for r in data if r[1] == user), key=lambda r: (r[2], r[0]))
        for event, following in zip(events, [*events[1:], None]):
            stays = following and following[2] - event[2] <= timedelta(minutes=10)
            pair = (event[3], following[3] if stays else "exit")
            expected[pair] = expected.get(pair, 0) + 1
    df = spark.createDataFrame(data, "seq int, id int, ts timestamp_ntz, kind string")
    out = transitions(df, "id", "ts", "kind", timedelta(minutes=10), ["seq"], split)
    assert {(r.from_event, r.to_event): r.n for r in out.collect()} == expected


@pytest.mark.parametrize("split", [HotSplit(), HotSplit(min_rows=10)])
def test_transitions_between_copies(spark, split):
    one = spark.range(50).selectExpr("1 AS id", "timestamp_ntz'2024-01-01' AS ts", "'a' AS kind")
    then = spark.range(1).selectExpr("1 AS id", "timestamp_ntz'2024-01-01 00:05:00' AS ts", "'b' AS kind")
    out = transitions(one.union(then), "id", "ts", "kind", timedelta(minutes=10), split=split)
    assert rows(out) == [("a", "a", 49), ("a", "b", 1), ("b", "exit", 1)]


@pytest.mark.parametrize("how", ["discrete", "approx"])
def test_rfm(spark, how):
    orders = [(i, START + timedelta(days=i), Decimal(i)) for i in range(1, 11) for _ in range(i)]
    df = spark.createDataFrame([*orders, (1, datetime(2030, 1, 1), Decimal(5))], "id int, ts timestamp_ntz, v decimal(18,2)")
    out = {r.id: r for r in rfm_segments(df, "id", "ts", "v", "2024-02-01", how=how).collect()}
    assert len(out) == 10
    for i in range(1, 11):
        score = (i + 1) // 2
        assert (out[i].f_score, out[i].m_score) == (score, score)
        assert out[i].frequency == i and out[i].monetary == i * i and out[i].recency_days == 31 - i
        assert 1 <= out[i].r_score <= 5
    assert out[10].r_score == 5 and out[1].r_score == 1


def test_cohort_value(spark):
    orders = [(1, 1, 10), (1, 1, 5), (2, 1, 5), (1, 3, 20), (3, 2, 7)]
    df = spark.createDataFrame([(i, datetime(2024, m, 5), Decimal(v)) for i, m, v in orders], "id int, ts timestamp_ntz, v decimal(18,2)")
    assert [tuple(r)[1:] for r in cohort_value(df, "id", "ts", "v").orderBy("cohort", "offset").collect()] == [
        (0, 2, 20, 20, 10.0),
        (2, 2, 20, 40, 20.0),
        (0, 1, 7, 7, 7.0),
    ]


def test_set_compare(spark):
    a = spark.createDataFrame([(1,), (1,), (2,), (None,)], "id int")
    b = spark.createDataFrame([(2,), (3,), (None,)], "id int")
    assert rows(period_set_compare(a, b, "id")) == [(1, "lost"), (2, "kept"), (3, "gained"), (None, "kept")]
