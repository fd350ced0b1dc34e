import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from dayfold.llm.lexical import BallTree, Best, Sparse, lexical_search, search_block

from .conftest import prose, words


def brute(rows, items, k=10):
    """The same figures with plain integers over all documents."""
    own = [(doc_id, Counter(words(text))) for doc_id, text in rows]
    own = [(doc_id, tf, sum(tf.values())) for doc_id, tf in own if tf]
    documents, total = len(own), sum(n for _, _, n in own)
    df = Counter(t for _, tf, _ in own for t in tf)
    out = []
    for item_id, text in items:
        scored = []
        for doc_id, tf, n in own:
            m = 100 - 90 + (90 * n * documents) // total
            score = sum(
                math.floor(1000 * math.log((2 * documents + 2) / (2 * df[t] + 1)))
                * ((1_000_000_000 * tf[t]) // (1000 * tf[t] + 8 * m))
                for t in set(words(text))
                if t in tf
            )
            if score:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        out += [(item_id, rank, s[3], -s[0]) for rank, s in enumerate(sorted(scored)[:k], 1)]
    return out


@pytest.fixture(scope="module")
def tables(spark, odd, odd_rows):
    make = random.Random(3)
    common = "of the and to in"
    items = [(n, prose(make.randint(1, 40), 300 + n)) for n in range(20)]
    items += [(50, common), (51, "the THE the"), (52, None), (53, ""), (54, "--"), (None, items[3][1]), (3, items[3][1])]
    rows = [r[:2] for r in odd_rows]
    for n in range(400):
        text = prose(make.randint(1, 60), 900 + n).split() + make.choices(common.split(), k=20)
        text += words(items[make.randrange(20)][1])[: make.randint(0, 30)]
        make.shuffle(text)
        rows.append((100 + n, ", ".join(text)))
    # Copies of one text are a tie that the smallest ids win.
    rows += [(1000 - n, items[7][1]) for n in range(300)] + [(1, items[7][1]), (1, items[7][1])]
    extra = ("x",) * (len(odd.columns) - 2)
    names = ", ".join(f"{c} string" for c in odd.columns[2:])
    docs = spark.createDataFrame([(*r, *extra) for r in rows], f"doc_id bigint, text string, {names}")
    bench = spark.createDataFrame([(*i, "x") for i in items], "item_id bigint, text string, row string")
    return docs, bench, rows, items


def found(df):
    return sorted([(r.item_id, r.rank, r.doc_id, r.score) for r in df.collect()], key=str)


def test_ranks_against_plain_search(tables):
    docs, bench, rows, items = tables
    expected = sorted(brute(rows, items), key=str)
    assert found(lexical_search(docs.repartition(3), bench)) == expected
    assert {r[0] for r in expected} > {7, 50, None}
    # Small blocks, leaves and rounds give the same rows.
    assert found(lexical_search(docs, bench, block=64, leaf=4, most_terms=100)) == expected


def test_other_k_and_names(tables, spark):
    docs, bench, rows, items = tables
    got = lexical_search(
        docs.withColumnsRenamed({"doc_id": "a", "text": "b"}),
        bench.withColumnsRenamed({"item_id": "c", "text": "d"}),
        3, "a", "b", "c", "d",
    )
    assert got.columns == ["c", "rank", "a", "score"]
    assert sorted([tuple(r) for r in got.collect()], key=str) == sorted(brute(rows, items, 3), key=str)
    with pytest.raises(ValueError, match="names of their own"):
        lexical_search(docs.withColumnRenamed("doc_id", "score"), bench, id_col="score")


def test_empty_tables(tables, none):
    docs, bench, _, _ = tables
    assert lexical_search(none, bench).collect() == []
    assert lexical_search(docs, bench.where("false")).collect() == []


def test_ids_of_text(spark):
    docs = spark.createDataFrame([("b", "one two"), ("a", "one two"), (None, "one two"), ("c", "three")], "doc_id string, text string")
    bench = spark.createDataFrame([(1, "one")], "item_id bigint, text string")
    assert [r.doc_id for r in lexical_search(docs, bench).orderBy("rank").collect()] == ["a", "b", None]


def test_bounds_hold_and_prune():
    make = np.random.default_rng(1)
    rows, columns, values = [], [], []
    for n in range(2000):
        topic = n % 8
        own = np.unique(make.integers(topic * 50, topic * 50 + 50, 12))
        rows.append(len(columns))
        columns += own.tolist()
        values += make.integers(1, 3 * 10**10, len(own)).tolist()
    data = Sparse(np.array(rows), np.array(columns), np.array(values, "int64"))
    tree = BallTree(data, 400, 32)
    ids = pa.array(range(2000), pa.int64())
    for topic in range(8):
        terms = np.arange(topic * 50, topic * 50 + 20)
        wanted = np.zeros(400, "int64")
        wanted[terms] = 1
        exact, bounds = data.dot(wanted), tree.bounds(terms)
        for node, (own, _) in tree.leaves.items():
            assert exact[own].max() <= bounds[node]
        best, seen = Best(10), {}
        search_block(tree, ids, terms, best, seen)
        order = sorted(range(2000), key=lambda n: (-exact[n], n))[:10]
        assert [r[1] for r in best.rows] == order
        assert seen["leaves"] < len(tree.leaves)
