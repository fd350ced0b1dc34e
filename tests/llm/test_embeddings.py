import math

import numpy as np
import pytest

from dayfold.llm import embeddings
from dayfold.llm.embeddings import _groups, embedding_near_dedup, nearest_pivots, roots, shared_counts, spread, unit

SCHEMA = "vec_id bigint, embedding array<float>, label int, node string, links string, n_links string, kept string"


def brute(rows, least=0.98):
    """Links and components by comparing all pairs."""
    def good(v, label):
        return label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)

    vectors = [unit(np.array([v], "float32").astype("float64"))[0] if good(v, label) else None for _, v, label in rows]
    links = [[] for _ in rows]
    for a in range(len(rows)):
        for b in range(a):
            x, y = vectors[a], vectors[b]
            if x is not None and y is not None and rows[a][2] == rows[b][2] and len(x) == len(y) and x @ y >= least:
                links[a].append(b)
                links[b].append(a)
    out = []
    for n, (vec_id, _, _) in enumerate(rows):
        seen, todo = {n}, [n]
        while todo:
            for other in links[todo.pop()]:
                if other not in seen:
                    seen.add(other)
                    todo.append(other)
        first = min((rows[m][0] for m in seen if rows[m][0] is not None), default=None)
        out.append((vec_id, len(links[n]), first, vec_id == first))
    return sorted(out, key=str)


def got(df):
    return sorted([(r[0], r.n_links, r.component_id, r.kept) for r in df.collect()], key=str)


def clouds(seed=1, width=16):
    """Single vectors, groups of copies, near copies and chains, and vectors without a direction."""
    make = np.random.default_rng(seed)
    rows = []

    def put(v, label):
        rows.append((1000 - len(rows), [float(x) for x in np.float32(v)], label))

    for label in (1, 2, 3):
        for _ in range(60):
            put(make.normal(size=width), label)
        for spread_by in (0.01, 0.05, 0.08):
            middle = make.normal(size=width)
            for _ in range(40):
                put(middle + make.normal(size=width) * spread_by, label)
        step = unit(make.normal(size=(2, width)))
        for n in range(12):
            put(step[0] * math.cos(n * 0.15) + step[1] * math.sin(n * 0.15), label)
    copy = make.normal(size=width)
    for n in range(70):
        put(copy, 1)
        put(copy * 4, 1 + n % 2)
    good = rows[5][1]
    odd = [None, [], [0.0] * width, [None, *good[1:]], [math.nan, *good[1:]], [math.inf, *good[1:]]]
    rows += [(2000 + n, v, 1) for n, v in enumerate(odd)] + [(2100, good, None), (2101, good, None), (2102, good[:4], 1)]
    rows += [(None, good, 1), (None, odd[1], 1), (7, good, 1), (7, [-x for x in good], 1), (7, good, 1)]
    rows += [(2200, [1e-30, -0.0] + [0.0] * (width - 2), 3), (2201, [3e30, 0.0] + [0.0] * (width - 2), 3)]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, *("x",) * 4) for r in rows], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def table(spark):
    rows = clouds()
    return frame(spark, rows), rows


def test_links_against_all_pairs(table):
    df, rows = table
    expected = brute(rows)
    assert got(embedding_near_dedup(df)) == expected
    assert sum(r[1] for r in expected) > 10_000 and any(0 < r[1] < 5 for r in expected)


def test_long_lists_in_blocks(table, monkeypatch):
    df, rows = table
    assert got(embedding_near_dedup(df, block=8, pivots=20)) == brute(rows)
    # Also where the list of long lists is not broadcast.
    monkeypatch.setattr(embeddings, "MOST_BROADCAST", 0)
    assert got(embedding_near_dedup(df, block=16, pivots=20)) == brute(rows)


def test_names_and_types(spark):
    rows = [("b", [1.0, 0.0], "x"), ("a", [1.0, 0.01], "x"), ("c", [1.0, 0.0], "y")]
    df = spark.createDataFrame(rows, "name string, v array<double>, kind string")
    out = embedding_near_dedup(df, id_col="name", vector_col="v", label_col="kind")
    assert got(out) == [("a", 1, "a", True), ("b", 1, "a", False), ("c", 0, "c", True)]
    with pytest.raises(ValueError, match="name of a result"):
        embedding_near_dedup(df.withColumnRenamed("name", "kept"), id_col="kept", vector_col="v", label_col="kind")


def test_empty_and_unusable(table):
    df, _ = table
    assert embedding_near_dedup(df.where("false")).collect() == []
    assert got(embedding_near_dedup(df.where("label IS NULL"))) == [(2100, 0, 2100, True), (2101, 0, 2101, True)]


def test_given_vectors(spark, folder):
    df = spark.read.parquet(f"{folder}/embeddings.parquet")
    rows = [tuple(r) for r in df.select("vec_id", "embedding", "label").collect()]
    assert got(embedding_near_dedup(df)) == brute(rows)


@pytest.mark.parametrize("pivots", [32, 256, 1024])
def test_recall_at_the_threshold(pivots):
    """Pairs with a cosine of exactly 0.98, the hardest ones, in 64 dimensions."""
    make = np.random.default_rng(2)
    x = unit(make.normal(size=(20_000, 64)))
    away = make.normal(size=x.shape)
    away = unit(away - (away * x).sum(1, keepdims=True) * x)
    y = 0.98 * x + math.sqrt(1 - 0.98**2) * away
    points = spread(unit(make.normal(size=(4 * pivots, 64))), pivots)
    signs = nearest_pivots(x, points, 6), nearest_pivots(y, points, 6)
    both = (signs[0][:, :, None] == signs[1][:, None, :]).sum((1, 2))
    assert (both >= 2).mean() > 0.998
    assert (shared_counts(signs[0][:50], signs[1][:50]).diagonal() == both[:50]).all()


def test_pivots_are_apart():
    make = np.random.default_rng(3)
    group = unit(make.normal(size=16) + make.normal(size=(900, 16)) * 0.02)
    points = spread(np.concatenate([group, unit(make.normal(size=(100, 16)))]), 50)
    assert len(points) == 50
    assert ((points @ group[0]) > 0.95).sum() <= 1


def test_roots():
    make = np.random.default_rng(4)
    a, b = make.integers(0, 300, (2, 200))
    expected = list(range(300))
    for _ in range(300):
        for x, y in zip(a, b):
            expected[x] = expected[y] = min(expected[x], expected[y])
    assert roots(300, a, b).tolist() == expected


def test_groups_over_batches():
    import pyarrow as pa

    make = np.random.default_rng(5)
    keys = np.sort(make.integers(0, 30, 200))
    batches = [pa.RecordBatch.from_arrays([pa.array(part)], names=["k"]) for part in np.array_split(keys, 23)]
    parts = [g["k"].to_pylist() for g in _groups(iter([batches[0].slice(0, 0), *batches]), ["k"])]
    assert [p[0] for p in parts] == sorted(set(keys.tolist())) and all(len(set(p)) == 1 for p in parts)
    assert sum(map(len, parts)) == 200
