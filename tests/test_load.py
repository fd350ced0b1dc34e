from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from dayfold.functions.columns import day_of, surrogate_key
from dayfold.session import work_folder
from dayfold.sources.load import load_increment, parse_json_column, write_daily_partition, write_day
from dayfold.sources.tables import read_table


def test_increment_is_half_open_and_pushed_down(spark, folder):
    rows = [(1, datetime(2024, 1, 1)), (2, datetime(2024, 1, 2)), (3, datetime(2024, 1, 3)), (4, None)]
    df = spark.createDataFrame(rows, "id int, ts timestamp_ntz")
    found = load_increment(df, "ts", date(2024, 1, 1), date(2024, 1, 3)).collect()
    assert sorted(r.id for r in found) == [1, 2]
    plan = load_increment(read_table(spark, folder, "events"), "ts", "2024-01-03", datetime(2024, 1, 5))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts" in text and "LessThan(ts" in text


def test_partition_rerun_gives_the_same_table(spark, folder):
    path = work_folder(spark, "t")
    events = read_table(spark, folder, "events").withColumn("dt", day_of("ts"))

    def content():
        return sorted(map(str, spark.read.parquet(path).select(events.columns).collect()))

    write_daily_partition(events, path)
    before = content()
    assert len(before) == events.count()
    write_daily_partition(events.where(F.col("dt") == F.lit(date(2024, 1, 5))), path)
    assert content() == before
    write_daily_partition(events.where((F.col("dt") == F.lit(date(2024, 1, 5))) & (F.col("user_id") < 0)), path)
    assert content() == before, "no days present, nothing replaced"
    changed = events.where(F.col("dt") == F.lit(date(2024, 1, 5))).withColumn("value", F.lit(0.0))
    write_daily_partition(changed, path)
    back = spark.read.parquet(path)
    assert back.where("dt = '2024-01-05' and value <> 0").count() == 0
    assert back.where("dt <> '2024-01-05'").count() == events.where("dt <> '2024-01-05'").count()


def test_one_day_may_become_empty(spark):
    path = work_folder(spark, "t")
    df = spark.createDataFrame([(1, date(2024, 1, 1))], "id int, dt date")
    write_day(df, path, date(2024, 1, 1))
    write_day(df.where("id < 0"), path, date(2024, 1, 1))
    assert spark.read.parquet(path).count() == 0


def test_json(spark):
    rows = [
        (1, '{"k": 5, "s": "x"}'),
        (2, '{"k": '),
        (3, '{"s": "y"}'),
        (4, '{"k": "five", "s": "z"}'),
        (5, None),
        (6, " "),
        (7, "[1]"),
        (8, "{'k': 1}"),
        (9, "{}"),
    ]
    df = spark.createDataFrame(rows, "id int, body string")
    out = {r.id: (r.k, r.s, r.is_malformed) for r in parse_json_column(df, "body", "k int, s string").collect()}
    assert out[1] == (5, "x", False)
    assert out[2] == (None, None, True)
    assert out[3] == (None, "y", False)
    assert out[4] == (None, "z", True)
    assert out[5] == out[9] == (None, None, False)
    assert out[6] == out[7] == out[8] == (None, None, True)
    assert parse_json_column(df, "body", "k int", keep_text=True).columns == ["id", "body", "k", "is_malformed"]


def test_text_behind_an_object_is_malformed(spark):
    texts = ['{"k":1} x', '{"k":1}{"k":2}', '{"k":1},{"k":2}', '{"k":1}],[{"k":2}', "[]", '[{"k":1}]', "1", "", ' {"k":1} ', '{"k":1}\n']
    df = spark.createDataFrame([(n, t) for n, t in enumerate(texts)], "id int, body string")
    out = [(r.k, r.is_malformed) for r in parse_json_column(df, "body", "k int").orderBy("id").collect()]
    assert out == [(None, True)] * 8 + [(1, False)] * 2


def test_surrogate_keys_tell_nulls_apart(spark):
    rows = [("a", None), (None, "a"), ("a", ""), ("", "a"), (None, None), ("-", None), ("1:a", "b"), ("a1:", "b")]
    df = spark.createDataFrame(rows, "x string, y string")
    assert df.select(surrogate_key("x", "y").alias("k")).distinct().count() == len(rows)


def test_work_folder_uses_the_shared_setting(spark):
    assert work_folder(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_a_cluster_without_a_shared_folder_is_refused():
    class Conf:
        def get(self, name, default):
            return default

    class Cluster:
        conf = Conf()
        sparkContext = type("Context", (), {"master": "yarn"})

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        work_folder(Cluster(), "x")


@pytest.mark.parametrize("period, start", [("day", date(2024, 2, 29)), ("week", date(2024, 2, 26)), ("year", date(2024, 1, 1))])
def test_period_start(spark, period, start):
    from dayfold.functions.columns import period_start

    df = spark.createDataFrame([(datetime(2024, 2, 29, 13),)], "ts timestamp_ntz")
    assert df.select(period_start("ts", period)).first()[0] == start
