import random
from collections import defaultdict

import numpy as np
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from dayfold.llm import near_dedup as near_dedup_module
from dayfold.llm.near_dedup import (
    aligned_similarity,
    components,
    near_dedup,
    order_minhash,
    shingle_counts,
    shingle_hashes,
    unlike_pairs,
    words_of,
)
from dayfold.llm.tables import Scratch

from .conftest import prose, words


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for n, y in enumerate(b, 1):
            last, row[n] = row[n], last + 1 if x == y else max(row[n], row[n - 1])
    return row[-1]


@given(st.lists(st.integers(0, 3), max_size=25), st.lists(st.integers(0, 3), max_size=25), st.sampled_from([0.3, 0.5, 0.8]))
def test_alignment(a, b, least):
    m = lcs(a, b)
    exact = m / (len(a) + len(b) - m) if a or b else 1.0
    assert aligned_similarity(a, b, least) == (exact if exact >= least else 0.0)


def test_words_and_shingles():
    text = "A b, É-c\x00 D9 e"
    assert [w.decode() for w in words_of(text)] == words(text)
    own = [w.encode() for w in "a b c d e f g".split()]
    assert shingle_hashes(own, 5)[1] == shingle_hashes(own[1:6], 5)[0]
    assert len(shingle_hashes(own[:3], 5)) == 1 and len(shingle_hashes([], 5)) == 0
    many = [w.encode() for w in prose(5000, 3).split()]
    assert len(np.unique(shingle_hashes(many, 1))) == len(set(many))


def test_sketches_tell_order_and_repeats():
    a = shingle_hashes([w.encode() for w in prose(60, 1).split()], 1)
    assert (order_minhash(a, 50, 2) == order_minhash(a, 50, 2)).all()
    assert (order_minhash(a, 50, 2) == order_minhash(a[::-1], 50, 2)).sum() == 0
    assert (order_minhash(a, 50, 1) == order_minhash(a[::-1], 50, 1)).all()
    assert (order_minhash(a, 50, 1) == order_minhash(np.concatenate([a, a]), 50, 1)).mean() < 0.8


def brute(rows, least=0.8):
    """Classes by comparing all pairs of texts that share a shingle."""
    texts = {}
    for doc_id, text in rows:
        texts.setdefault(tuple(words(text)), set()).add(doc_id)
    shingles = {w: [w[n : n + 5] for n in range(max(1, len(w) - 4))] if w else [] for w in texts}
    by_shingle = defaultdict(set)
    for w, own in shingles.items():
        for s in own:
            by_shingle[s].add(w)
    parent = {w: w for w in texts}

    def top(w):
        while parent[w] != w:
            w = parent[w]
        return w

    for group in by_shingle.values():
        group = sorted(group)
        for n, x in enumerate(group):
            for y in group[:n]:
                a, b = shingles[x], shingles[y]
                if top(x) != top(y) and min(len(a), len(b)) >= least * max(len(a), len(b)):
                    m = lcs(a, b)
                    if m >= least * (len(a) + len(b) - m):
                        parent[top(x)] = top(y)
    smallest = {}
    for w, ids in texts.items():
        smallest[top(w)] = min(ids | {smallest.get(top(w), min(ids))})
    return {doc_id: smallest[top(w)] for w, ids in texts.items() for doc_id in ids}


def mutated(text, share, make):
    return " ".join(w + "x" if make.random() < share else w for w in text.split())


def test_classes_against_all_pairs(spark, documents):
    make = random.Random(5)
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    originals = [prose(200, n) for n in range(20)]
    for n, text in enumerate(originals):
        rows += [(10_000 + 100 * n + k, mutated(text, 0.004 * k, make)) for k in range(6)]
    # The same words in another order are no near copy.
    turned = [w for n in range(0, 200, 10) for w in reversed(originals[0].split()[n : n + 10])]
    rows += [(20_000, " ".join(turned)), (20_001, originals[0].upper())]
    got = near_dedup(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {r.doc_id: r.class_id for r in got} == brute(rows)
    kept = defaultdict(int)
    for r in got:
        kept[r.class_id] += r.keep
        assert r.links > 0 or r.class_id == r.doc_id or r.doc_id not in {d for d, _ in rows[-2:]}
    assert set(kept.values()) == {1}


def test_odd_rows(odd, odd_rows):
    got = near_dedup(odd, carry=["n_chars"]).collect()
    assert len(got) == len(odd_rows)
    # Rows by number, as ids repeat; a class is named by the smallest id of its rows.
    named = [r for r in odd_rows if r[0] is not None]
    group = brute([(n, r[1]) for n, r in enumerate(named)])
    smallest = {g: min(named[n][0] for n in group if group[n] == g) for g in group.values()}
    expected = sorted((r[0], r[4] or -1, smallest[group[n]]) for n, r in enumerate(named))
    assert sorted((r.doc_id, r.n_chars or -1, r.class_id) for r in got if r.doc_id is not None) == expected
    assert sum(r.keep for r in got if r.doc_id is not None) == len(smallest)
    assert all(r.keep and r.class_id is None for r in got if r.doc_id is None)


def test_texts_that_share_an_id(spark):
    """Each text of a repeated id is compared with all others, those of the same id too."""
    text, other, far = prose(60, 41), prose(60, 42), prose(60, 43)
    rows = [(1, text), (2, other), (2, text + " more"), (3, far), (3, far + " more"), (0, other + " more"), (4, prose(60, 44))]
    found = near_dedup(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    got = sorted((r.doc_id, r.class_id, r.links, r.keep) for r in found)
    assert [g[:3] for g in got] == [(0, 0, 1), (1, 1, 1), (2, 0, 1), (2, 1, 1), (3, 3, 1), (3, 3, 1), (4, 4, 0)]
    assert [g[0] for g in got if g[3]] == [0, 1, 3, 4]


def test_empty_table(none):
    assert near_dedup(none).collect() == []


def test_components(spark):
    make = random.Random(2)
    edges = [(n, n + 1) for n in range(60)] + [(make.randrange(100, 400), make.randrange(100, 400)) for _ in range(200)]
    edges += [(1000, n) for n in range(1001, 1500)]
    links = spark.createDataFrame(edges, "a bigint, b bigint")
    got = {r.node: r.class_id for r in components(links, Scratch(spark, "t")).collect()}
    parent = {}

    def top(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = sorted((top(a), top(b)))
        parent[y] = x
    assert {n: got.get(n, n) for n in parent} == {n: top(n) for n in parent}


def test_components_stop_at_stars(spark):
    """Links that are stars need no round, and rounds on few links write few files, whatever the number of partitions."""
    scratch = Scratch(spark, "t")
    links = spark.createDataFrame([(1, n) for n in range(2, 9)] + [(20, 10), (30, 10), (7, 7)], "a bigint, b bigint")
    got = {r.node: r.class_id for r in components(links, scratch).collect()}
    assert got == {n: 1 for n in range(2, 9)} | {20: 10, 30: 10} and scratch.made == 1
    assert components(links.where("false"), Scratch(spark, "t")).collect() == []
    # Two edges of one node, and a node that is both ends, are no stars.
    for edges in ([(3, 1), (3, 2)], [(2, 1), (3, 2)]):
        found = components(spark.createDataFrame(edges, "a bigint, b bigint"), Scratch(spark, "t"))
        assert {r.node: r.class_id for r in found.collect()} == {2: 1, 3: 1}
        assert len(found.inputFiles()) == 1


def aligned_classes(rows, least=0.8):
    """Classes by aligning all pairs of texts whose ids are less than 1000 apart."""
    shingles = {doc_id: shingle_hashes(words_of(text), 5).tolist() for doc_id, text in rows}
    parent = {doc_id: doc_id for doc_id in shingles}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in shingles:
        for b in range(a + 1, a + 1000):
            if b not in shingles:
                continue
            x, y = sorted((top(a), top(b)))
            if x != y and aligned_similarity(shingles[a], shingles[b], least):
                parent[y] = x
    return {doc_id: top(doc_id) for doc_id in shingles}


def test_members_unlike_both_ends(spark):
    """Buckets of a passage that unlike texts share, and a group that drifts: no link is lost."""
    make, passage = random.Random(11), prose(200, 77)
    rows = []
    for n in range(0, 240, 2):
        own = prose(60, 500 + n).split()
        turned = list(own)
        for k in make.sample(range(0, 60, 6), 3):
            turned[k] += "x"
        rows += [(n, f"{passage} {' '.join(own)}"), (n + 1, f"{passage} {' '.join(turned)}")]
    drift = prose(150, 78).split()
    for n in range(2000, 2120):
        drift[make.randrange(150)] += "x"
        if n % 2:
            drift[make.randrange(150)] += "y"
        rows.append((n, " ".join(drift)))
    make.shuffle(rows)
    got = near_dedup(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    expected = aligned_classes(rows)
    assert [r for r in got if r.class_id != expected[r.doc_id]] == []


def open_nodes(spark, texts):
    """Nodes as the operator makes them, all in the same 14 buckets."""
    shingles = [shingle_hashes(words_of(text), 5) for text in texts]
    rows = [(n, list(range(14)), len(s), shingle_counts(s).tobytes()) for n, s in enumerate(shingles)]
    nodes = spark.createDataFrame(rows, "node bigint, keys array<bigint>, n bigint, counts binary")
    return nodes, spark.createDataFrame([], "node bigint, class_id bigint")


class Counted(Scratch):
    """A scratch folder that knows how many rows each table has."""

    def write(self, df):
        out = super().write(df)
        self.rows = [*getattr(self, "rows", []), out.count()]
        return out


def test_sketches_are_fetched_once_a_node(spark):
    """Members of many buckets that are all mixed: their sketches are joined by node, and far lengths do not meet."""
    joined = []
    for lengths in ([60] * 20, [40 * 2**n for n in range(8)]):
        nodes, classes = open_nodes(spark, [prose(n, 900 + k) for k, n in enumerate(lengths)])
        scratch = Counted(spark, "t")
        assert near_dedup_module._open_pairs(nodes, classes, F.col("keys"), None, 4, 0.8, scratch) == (None, None)
        # The tables: nodes, buckets, members by slot, slots, places, pairs and the slots left.
        joined.append(scratch.rows[4])
    assert joined == [20, 0]


def test_open_pairs_over_bands_and_blocks(spark, monkeypatch):
    """Every pair that lengths and counts allow is found, in whichever bands and blocks it is."""
    monkeypatch.setattr(near_dedup_module, "BLOCK", 3)
    text = prose(400, 950).split()
    texts = [" ".join(text[: 60 + 9 * n]) for n in range(30)]
    nodes, classes = open_nodes(spark, texts)
    own = [r.asDict() for r in nodes.collect()]
    pairs, rest = near_dedup_module._open_pairs(nodes, classes, F.col("keys"), None, 4, 0.8, Scratch(spark, "t"))
    side = (
        np.arange(30),
        np.array([r["n"] for r in own]),
        np.array([r["keys"] for r in own]),
        np.array([list(r["counts"]) for r in own], dtype="uint8"),
    )
    a, b, _ = unlike_pairs(side, None, 0, 0.8)
    assert len(a) and {tuple(r) for r in pairs.collect()} == set(zip(a.tolist(), b.tolist())) and rest is None


def test_only_wanted_texts_are_shuffled(spark):
    """The map of marks keeps every wanted text and few others."""
    marked = near_dedup_module._marked
    texts = spark.range(20_000).select("id", F.xxhash64("id").alias("mark"), F.lit("t").alias("text"))
    wanted = texts.where("id % 40 = 3").select(F.col("id").alias("node"), "id", "mark")
    left = marked(texts, wanted)
    assert left.columns == texts.columns
    assert left.join(wanted, ["id", "mark"]).count() == wanted.count() == 500
    assert left.count() < 1500
    assert marked(texts, wanted.where("false")).count() == 0
