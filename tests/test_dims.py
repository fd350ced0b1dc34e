import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from dayfold.functions.hot import HotSplit
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

TINY = HotSplit(min_rows=3, rows_per_cell=2)
OPEN = datetime(9999, 12, 31)
SCHEMA = "key bigint, ts timestamp_ntz, seq bigint, attr_a string, attr_b int"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def random_changes(seed=1, n=300):
    rnd = random.Random(seed)
    start = datetime(2024, 1, 1)
    out = []
    for seq in range(n):
        # One key has most of the rows; NULL is a key like any other.
        key = rnd.choice([7, 7, 7, 7, 7, 1, 2, 3, None])
        ts = start + timedelta(days=rnd.randrange(40))
        out.append((key, ts, seq, rnd.choice(["x", "y", None]), rnd.choice([1, None])))
    return out


def expected_history(changes):
    last = {}
    for key, ts, seq, a, b in changes:
        if (key, ts) not in last or last[key, ts][0] < seq:
            last[key, ts] = (seq, a, b)
    out = []
    for key in {k for k, _ in last}:
        versions = []
        for ts in sorted(t for k, t in last if k == key):
            state = last[key, ts][1:]
            if not versions or versions[-1][0] != state:
                versions.append((state, ts))
        for i, (state, ts) in enumerate(versions):
            end = versions[i + 1][1] if i + 1 < len(versions) else OPEN
            out.append((key, *state, ts, end, end == OPEN))
    return sorted(out, key=str)


@pytest.mark.parametrize("split", [HotSplit(), TINY, HotSplit(min_rows=3, rows_per_cell=2)])
@pytest.mark.parametrize("seed", [1, 2])
def test_scd2_build(spark, split, seed):
    changes = random_changes(seed)
    df = spark.createDataFrame(changes, SCHEMA)
    out = scd2_build(df, ["key"], "ts", ["attr_a", "attr_b"], ["seq"], split)
    assert rows(out) == expected_history(changes)


def test_scd2_apply_over_days_equals_build(spark):
    changes = [c for c in random_changes(3, 120) if c[1] < datetime(2024, 1, 5)]
    df = spark.createDataFrame(changes, SCHEMA).coalesce(2)
    built = scd2_build(df, ["key"], "ts", ["attr_a", "attr_b"], ["seq"])
    history = spark.createDataFrame([], built.schema)
    for day in sorted({c[1] for c in changes}):
        of_day = latest_by_key(df.where(df.ts == day), ["key"], ["seq"])
        history = scd2_apply(history, of_day, day, ["key"], ["attr_a", "attr_b"])
        # The days would otherwise pile up in one plan.
        history = spark.createDataFrame(history.collect(), built.schema)
    assert rows(history) == expected_history(changes)


def test_scd2_apply_rejects_an_earlier_day_but_takes_a_repeat(spark):
    schema = "key int, a string, valid_from date, valid_to date, is_current boolean"
    history = spark.createDataFrame([(1, "x", date(2024, 1, 5), date(9999, 12, 31), True)], schema)
    same = spark.createDataFrame([(1, "x")], "key int, a string")
    other = spark.createDataFrame([(1, "y")], "key int, a string")
    assert rows(scd2_apply(history, same, date(2024, 1, 5), ["key"], ["a"])) == rows(history)
    with pytest.raises(Exception, match="not after the current version"):
        scd2_apply(history, other, date(2024, 1, 5), ["key"], ["a"]).collect()


HISTORY = [
    (1, "a", datetime(2024, 1, 1), datetime(2024, 1, 10), False),
    (1, "b", datetime(2024, 1, 10), datetime(2024, 1, 20), False),
    (1, None, datetime(2024, 1, 25), OPEN, True),
    (2, "z", datetime(2024, 1, 1), OPEN, True),
    (None, "n", datetime(2024, 1, 1), OPEN, True),
]
FACTS = [
    (1, 1, datetime(2023, 12, 31), "unknown"),
    (2, 1, datetime(2024, 1, 1), "a"),
    (3, 1, datetime(2024, 1, 10), "b"),
    (4, 1, datetime(2024, 1, 20), "unknown"),
    (5, 1, datetime(2024, 1, 26), None),  # the version says NULL
    (6, 2, datetime(2025, 1, 1), "z"),
    (7, 3, datetime(2024, 1, 1), "unknown"),
    (8, None, datetime(2024, 1, 1), "unknown"),
    (9, 1, None, "unknown"),
]


@pytest.mark.parametrize("small", [True, False, None])
@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp", "date"])
@pytest.mark.parametrize("bucket", [timedelta(days=1), timedelta(seconds=1), timedelta(days=10_000)])
def test_scd2_lookup(spark, small, kind, bucket):
    history = spark.createDataFrame(
        HISTORY, "k bigint, attr string, valid_from timestamp_ntz, valid_to timestamp_ntz, is_current boolean"
    )
    facts = spark.createDataFrame([f[:3] for f in FACTS], "id int, key bigint, at timestamp_ntz")
    history = history.withColumns({c: F.col(c).cast(kind) for c in ("valid_from", "valid_to")})
    out = scd2_lookup(
        facts.withColumn("at", F.col("at").cast(kind)), history, {"key": "k"}, "at", {"attr": "attr"}, bucket=bucket, small=small
    )
    out = out.withColumn("at", F.col("at").cast("timestamp_ntz"))
    assert rows(out) == sorted(((f[0], *f[1:]) for f in FACTS), key=str)


@pytest.mark.parametrize("small", [True, False])
def test_lookup_at_all_lengths(spark, small):
    """Versions from a microsecond to centuries, with gaps, before and after 1970, against a plain search."""
    make, history, facts = random.Random(9), [], []
    for key in range(12):
        at = datetime(1900 + 6 * key, 1, 1)
        for n in range(40):
            until = at + timedelta(microseconds=int(10 ** make.uniform(0, 14 if key % 2 else 9)))
            history.append((key, n, at, until))
            at = until + timedelta(microseconds=make.choice([0, 0, 1, 10**6]))
        history.append((key, 40, at, datetime(9999, 12, 31)))
        history.append((key, 41, at, at))
    for n in range(600):
        key, _, since, until = make.choice(history)
        at = make.choice([since, until, since - timedelta(microseconds=1), since + (until - since) * make.random()])
        facts.append((n, key if make.random() < 0.95 else 99, at))
    table = spark.createDataFrame(history, "k int, v int, valid_from timestamp_ntz, valid_to timestamp_ntz")
    df = spark.createDataFrame(facts, "id int, key bigint, at timestamp_ntz")
    found = {r.id: r.v for r in scd2_lookup(df, table, {"key": "k"}, "at", {"v": "v"}, small=small).collect()}
    assert len(found) == 600
    for n, key, at in facts:
        assert found[n] == next((v for k, v, since, until in history if k == key and since <= at < until), None), (n, key, at)


def test_lookup_of_numbers_and_days(spark):
    history = spark.sql("SELECT 1 AS k, id AS v, id * 3 - 9 AS valid_from, id * 3 - 6 AS valid_to FROM range(10)")
    facts = spark.sql("SELECT 1 AS k, id - 12 AS at FROM range(40)")
    for small in (True, False):
        out = scd2_lookup(facts, history, {"k": "k"}, "at", {"v": "v"}, small=small)
        assert {r.at: r.v for r in out.collect()} == {at: (at + 9) // 3 if -9 <= at < 21 else None for at in range(-12, 28)}
    with pytest.raises(TypeError, match="no time order"):
        scd2_lookup(facts.withColumn("at", F.lit("x")), history, {"k": "k"}, "at", {"v": "v"}, small=True)


def test_lookup_meets_the_versions_of_one_bucket(spark):
    """A key with 10,000 versions and 100,000 keys with 65 each; no job runs until rows are asked for."""
    many = spark.range(100_000).select("id", F.explode(F.sequence(F.lit(0), F.lit(64))).alias("n"))
    many = many.union(spark.range(10_000).select(F.lit(-1).cast("bigint"), F.col("id").cast("int")))
    since = (F.timestamp_seconds(F.col("n") * 86_400)).cast("timestamp_ntz")
    until = (F.timestamp_seconds((F.col("n") + 1) * 86_400)).cast("timestamp_ntz")
    history = many.select("id", F.col("n").alias("v"), since.alias("valid_from"), until.alias("valid_to"))
    facts = spark.range(200_000).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") % 100_000).alias("key"),
        F.timestamp_seconds((F.col("id") % 64) * 86_400 + 5).cast("timestamp_ntz").alias("at"),
        (F.col("id") % 64).alias("expected"),
    )
    store = spark.sparkContext._jsc.sc().statusStore()
    before = store.jobsList(None).size()
    out = scd2_lookup(facts, history, {"key": "id"}, "at", {"v": "v"}, small=False)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert store.jobsList(None).size() == before
    joins = [line for line in plan.splitlines() if "Join" in line]
    assert len(joins) == 1 and "shiftright" in joins[0]
    right = out.select((F.col("v") == F.col("expected")).alias("ok")).groupBy("ok").count().collect()
    assert [(r.ok, r["count"]) for r in right] == [(True, 200_000)]


def test_found_nulls_stay_and_defaults_follow_the_type(spark):
    base = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    side = spark.createDataFrame([(1, None, None, None)], "n int, name string, size int, since date")
    take = {"name": "name", "size": "size", "since": "since"}
    out = denormalize_dim(base, [Lookup(side, {"k": "n"}, take)])
    missing = ("unknown", None, None)
    assert rows(out) == sorted([(1, None, None, None), (2, *missing), (None, *missing)], key=str)
    history = side.selectExpr("n", "name", "size", "since", "timestamp_ntz'2024-01-01' valid_from", "timestamp_ntz'2025-01-01' valid_to")
    facts = base.selectExpr("k", "timestamp_ntz'2024-06-01' at")
    for small in (True, False):
        found = scd2_lookup(facts, history, {"k": "n"}, "at", take, small=small).drop("at")
        assert rows(found) == sorted([(1, None, None, None), (2, *missing), (None, *missing)], key=str)


def test_denormalize_keeps_the_row_count(spark):
    base = spark.createDataFrame([(1, 1), (2, 9), (3, None)], "id int, n int")
    nation = spark.createDataFrame([(1, "N1", 5), (1, "N1b", 5), (2, None, 6)], "n int, name string, r int")
    region = spark.createDataFrame([(5, "R5")], "r int, label string")
    out = denormalize_dim(
        base,
        [
            Lookup(nation, {"n": "n"}, {"nation": "name", "r": "r"}, {"r": -1}),
            Lookup(region, {"r": "r"}, {"region": "label"}, unique=True),
        ],
    )
    assert rows(out) == [(1, 1, "N1b", 5, "R5"), (2, 9, "unknown", -1, "unknown"), (3, None, "unknown", -1, "unknown")]


def test_upsert_takes_the_whole_row(spark):
    current = spark.createDataFrame([(1, "a", "b"), (2, "c", "d"), (None, "e", "f")], "k int, x string, y string")
    changes = spark.createDataFrame([(2, "C", None), (3, "n", "n"), (None, "E", None)], "k int, x string, y string")
    out = scd1_upsert(current, changes, ["k"])
    assert rows(out) == sorted([(1, "a", "b"), (2, "C", None), (3, "n", "n"), (None, "E", None)], key=str)


def test_calendar(spark):
    days = {r.dt: r for r in calendar_dim(spark, "2023-12-30", date(2024, 3, 1)).collect()}
    assert len(days) == 63
    leap, new_year = days[date(2024, 2, 29)], days[date(2024, 1, 1)]
    assert (leap.is_month_end, leap.quarter, leap.iso_weekday) == (True, 1, 4)
    assert (new_year.iso_week, new_year.iso_weekday, new_year.is_weekend) == (1, 1, False)
    assert days[date(2023, 12, 31)].iso_week == 52 and days[date(2023, 12, 31)].is_weekend
