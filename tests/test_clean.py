from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import functions as F

from dayfold.operators.clean import (
    conform_types,
    latest_by_key,
    mask_columns,
    orphan_rows,
    split_valid,
    tag_rejects,
)


def test_latest_keeps_null_keys_and_prefers_values_to_null(spark):
    rows = [(1, None, 1), (1, 5, 2), (1, 5, 3), (None, 1, 4), (None, 2, 5)]
    df = spark.createDataFrame(rows, "k int, t int, seq int")
    assert sorted(r.seq for r in latest_by_key(df, ["k"], ["t", "seq"]).collect()) == [3, 5]


def test_conform(spark):
    rows = [("12", "2024-01-31"), ("x", "31.1."), ("", ""), (None, None)]
    df = spark.createDataFrame(rows, "n string, d string")
    out = conform_types(df, {"n": ("decimal(10,2)", -1), "d": ("date", "1970-01-01")}).collect()
    good, none = (Decimal("12.00"), date(2024, 1, 31)), (Decimal("-1.00"), date(1970, 1, 1))
    assert [tuple(r) for r in out] == [good, none, none, none]


def test_split_valid_counts_null_as_failed(spark):
    df = spark.createDataFrame([(1, 5), (2, -5), (3, None)], "id int, n int")
    rules = {"positive": F.col("n") > 0, "small": F.col("n") < 10}
    valid, rejected = split_valid(df, rules)
    assert [r.id for r in valid.collect()] == [1]
    assert valid.columns == df.columns
    reasons = {r.id: r.reject_reasons for r in rejected.collect()}
    assert reasons == {2: ["positive"], 3: ["positive", "small"]}
    assert tag_rejects(df, rules).count() == 3


def test_orphans(spark):
    child = spark.createDataFrame([(1, 1), (2, 2), (3, None), (4, None), (5, 7)], "id int, p bigint")
    parent = spark.createDataFrame([(1,), (1,), (2,), (None,)], "pid bigint")
    assert sorted(r.id for r in orphan_rows(child, parent, {"p": "pid"}).collect()) == [3, 4, 5]
    assert sorted(r.id for r in orphan_rows(child, parent, {"p": "pid"}, ["id"]).collect()) == [3, 4, 5]
    assert orphan_rows(child, parent, {"p": "pid"}).columns == child.columns


def test_masks(spark):
    df = spark.createDataFrame([("1234567890", "ab"), (None, None)], "card string, short string")
    out = mask_columns(df, {"card": ("keep_last", 4), "short": ("keep_last", 2)}, "s").collect()
    assert tuple(out[0]) == ("******7890", "**") and tuple(out[1]) == (None, None)
    a = mask_columns(df, {"card": "hash"}, "s").first()[0]
    b = mask_columns(df, {"card": "hash"}, "t").first()[0]
    assert len(a) == 64 and a != b


def test_latest_on_timestamps(spark):
    df = spark.createDataFrame([(1, datetime(2024, 1, 1)), (1, datetime(2024, 1, 2))], "k int, t timestamp_ntz")
    assert latest_by_key(df, ["k"], ["t"]).first().t == datetime(2024, 1, 2)
