from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from dayfold.operators.quality import (
    InRange,
    InSet,
    NotNull,
    References,
    Unique,
    profile_columns,
    reconcile,
    reconcile_digests,
    rule_audit,
    volume_drift,
)
from dayfold.session import work_folder


def status(df):
    return {r.status: r["keys"] for r in df.collect()}


@pytest.mark.parametrize("approx", [False, True])
def test_profile(spark, approx):
    df = spark.createDataFrame([(9, "b"), (10, None), (10, "a")], "n int, s string")
    out = {r["column"]: tuple(r)[1:] for r in profile_columns(df, approx=approx).collect()}
    assert out == {"n": (3, 0, 2, "9", "10"), "s": (3, 1, 2, "a", "b")}


def test_profile_of_no_rows(spark):
    df = spark.createDataFrame([], "n int")
    assert [tuple(r) for r in profile_columns(df).collect()] == [("n", 0, 0, 0, None, None)]


def test_audit(spark):
    df = spark.createDataFrame([(1, "a", 5), (1, "b", None), (2, "x", 50), (None, None, 7)], "k int, s string, n int")
    parent = spark.createDataFrame([(1,), (1,), (3,)], "id int")
    out = rule_audit(
        df,
        {
            "k": NotNull("k"),
            "n": InRange("n", 0, 10),
            "s": InSet("s", ["a", "b"]),
            "key": Unique(["k"]),
            "parent": References("k", parent, "id"),
            "none": NotNull("k"),
        },
    )
    assert {r.rule: r.failures for r in out.collect()} == {"k": 1, "n": 2, "s": 2, "key": 1, "parent": 2, "none": 1}


def test_audit_without_failures(spark):
    df = spark.createDataFrame([(1,)], "k int")
    out = rule_audit(df, {"key": Unique(["k"]), "parent": References("k", df, "k")})
    assert {r.rule: r.failures for r in out.collect()} == {"key": 0, "parent": 0}


def test_drift(spark):
    values = [10, 10, 10, 12, 13, 5]
    df = spark.createDataFrame([("a", date(2024, 1, 1) + timedelta(days=i), v) for i, v in enumerate(values)], "k string, dt date, v bigint")
    out = [(r.previous_mean, r.is_drift) for r in volume_drift(df, ["k"], "v", 2, 0.2).orderBy("dt").collect()]
    assert out == [(None, None), (None, None), (10.0, False), (10.0, False), (11.0, False), (12.5, True)]


def test_reconcile_is_null_safe(spark):
    schema = "k bigint, v string, w int"
    a = spark.createDataFrame([(1, "x", 1), (2, None, 1), (3, None, 1), (4, "x", 1), (None, "n", 1)], schema)
    b = spark.createDataFrame([(2, None, 1), (3, "y", 1), (4, "x", 1), (5, "z", 1), (None, "n", 1)], schema)
    assert status(reconcile(a, b, ["k"])) == {"only_left": 1, "only_right": 1, "different": 1, "same": 3, "repeated": 0}
    both = reconcile(a.union(a), b, ["k"])
    assert status(both) == {"only_left": 0, "only_right": 1, "different": 0, "same": 0, "repeated": 5}


def test_reconcile_rows_with_multiplicity(spark):
    a = spark.createDataFrame([(1,), (1,), (1,), (None,), (2,)], "k int")
    b = spark.createDataFrame([(1,), (None,), (None,), (3,)], "k int")
    assert status(reconcile(a, b, [])) == {"only_left": 3, "only_right": 2, "same": 2}
    assert status(reconcile(a.limit(0), b.limit(0), [])) == {"only_left": 0, "only_right": 0, "same": 0}


@pytest.mark.parametrize("changed", [0, 1, 40, 3000])
def test_digests_find_what_differs(spark, changed):
    a = spark.range(3000).selectExpr("IF(id = 5, NULL, id) AS k", "id % 7 AS x", "IF(id % 3 = 0, NULL, 't') AS y")
    new = a.where(f"x IS NOT NULL AND coalesce(k, 5) < {changed}")
    b = a.where(f"coalesce(k, 5) >= {changed}").unionByName(new.selectExpr("k + (k % 2) * 5000 AS k", "x + 1 AS x", "y"))
    b = b.repartition(5).withColumn("x", F.col("x").cast("int"))
    for keys in (["k"], []):
        expected = sorted(map(tuple, reconcile(a, b, keys).collect()))
        for sizes in ((4096, 1024), (16, 4), (1, 1)):
            assert sorted(map(tuple, reconcile_digests(a, b, keys, *sizes).collect())) == expected
    twice = a.unionByName(a)
    assert dict(map(tuple, reconcile_digests(twice, a, []).collect())) == {"same": 3000, "only_left": 3000, "only_right": 0}
    empty = a.where("false")
    assert dict(map(tuple, reconcile_digests(empty, empty, ["k"]).collect()))["same"] == 0


def test_equal_tables_shuffle_digests_alone(spark):
    a = spark.range(200_000).selectExpr("id AS k", "id % 7 AS x")
    path = work_folder(spark, "equal")
    a.write.parquet(path)
    df = reconcile_digests(a, spark.read.parquet(path), ["k"], buckets=64)
    store, gateway = spark.sparkContext._jsc.sc().statusStore(), spark.sparkContext._gateway

    def stages():
        found = store.stageList(None, False, False, gateway.new_array(gateway.jvm.double, 0), gateway.jvm.java.util.ArrayList())
        return {found.apply(n).stageId(): found.apply(n).shuffleWriteRecords() for n in range(found.size())}

    before = stages()
    assert dict(map(tuple, df.collect()))["same"] == 200_000
    assert 0 < sum(n for stage, n in stages().items() if stage not in before) < 5000
