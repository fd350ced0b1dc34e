import random

import pytest

from dayfold.llm.decontaminate import find_contamination, find_near_passages, without_contamination

from .conftest import prose, words


def brute(text, items, size=10):
    own, hit, found = words(text), set(), set()
    for item, item_text in items:
        wanted = words(item_text)
        length = min(size, len(wanted))
        windows = {tuple(wanted[n : n + length]) for n in range(len(wanted) - length + 1)} if wanted else set()
        for n in range(len(own) - length + 1):
            if length and tuple(own[n : n + length]) in windows:
                hit |= set(range(n, n + length))
                found.add(item)
    listed = sorted(str(i) for i in found if i is not None)
    return len(own), len(hit), listed


@pytest.fixture(scope="module")
def tables(spark, odd, odd_rows):
    make = random.Random(1)
    common = "of the and to of the and to of the of the and"
    items = [(n, prose(make.randint(1, 40), 300 + n)) for n in range(30)]
    items += [(50, common), (51, "the the"), (52, None), (53, ""), (None, items[3][1]), (3, items[3][1]), (54, items[4][1].upper())]
    rows = [r[:2] for r in odd_rows]
    for n in range(60):
        text = prose(80, 900 + n).split()
        other = words(items[make.randrange(30)][1])
        start = make.randrange(max(1, len(other) - 8))
        text[40:40] = other[start : start + make.choice([9, 10, 11, 60])]
        rows.append((100 + n, ", ".join(text)))
    rows += [(300, f"{common} {common}"), (301, "of the " * 500), (302, "The, THE the"), (303, None)]
    extra = ("x",) * (len(odd.columns) - 2)
    names = ", ".join(f"{c} string" for c in odd.columns[2:])
    docs = spark.createDataFrame([(*r, *extra) for r in rows], f"doc_id bigint, text string, {names}")
    bench = spark.createDataFrame([(*i, "x") for i in items], "item_id bigint, text string, row string")
    return docs, bench, rows, items


def test_hits_against_plain_search(tables):
    docs, bench, rows, items = tables
    got = [(r.doc_id, r.n_words, r.n_hit, list(r["items"])) for r in find_contamination(docs, bench).collect()]
    expected = [(doc_id, *brute(text, items)) for doc_id, text in rows]
    assert sorted(got, key=str) == sorted(expected, key=str)
    assert any(e[2] for e in expected)


def test_clean_rows_stay_whole(tables):
    docs, bench, rows, items = tables
    got = without_contamination(docs, bench)
    assert got.columns == docs.columns
    left = [r for r in rows if not brute(r[1], items)[1]]
    assert sorted([(r.doc_id, r.text) for r in got.collect()], key=str) == sorted(left, key=str)


def test_empty_tables(tables, none):
    docs, bench, rows, _ = tables
    assert find_contamination(none, bench).collect() == []
    assert all(r.n_hit == 0 for r in find_contamination(docs, bench.where("false")).collect())


def brute_near(text, items, size=10, share=0.8, slop=2):
    """Rows of one text: (item, window words, windows, most words met, first start)."""
    own, out = words(text), {}
    places = {}
    for n, w in enumerate(own):
        places.setdefault(w, set()).add(n)
    for item, item_text in items:
        wanted = words(item_text)
        length = min(size, len(wanted))
        for window in {tuple(wanted[n : n + length]) for n in range(len(wanted) - length + 1)} if wanted else ():
            met = {}
            for o, w in enumerate(window):
                for p in places.get(w, ()):
                    for start in range(p - o - slop, p - o + slop + 1):
                        met.setdefault(start, set()).add(o)
            for start, offsets in met.items():
                if len(offsets) >= share * length - 1e-9:
                    found = out.setdefault(item, [length, set(), 0, start])
                    found[1].add(window)
                    found[2:] = [max(found[2], len(offsets)), min(found[3], start)]
    return {(item, length, len(windows), most, first) for item, (length, windows, most, first) in out.items()}


def near_rows(found):
    return sorted((tuple(r) for r in found.collect()), key=str)


def test_proximity_against_plain_search(tables):
    """Windows with changed, added and missing words, NULL and repeated rows, frequent words, at the defaults."""
    docs, bench, rows, items = tables
    make = random.Random(3)
    texts = [r for r in rows if len(r[1] or "") < 20_000]
    for n in range(60):
        own = prose(60, 2000 + n).split()
        other = words(items[make.randrange(30)][1])[:25]
        for _ in range(make.randint(1, 4)):
            at = make.randrange(len(other))
            other[at : at + 1] = make.choice([["changed"], [], [other[at], "added"]]) or ["x"]
        at = make.choice([0, 30, 60])
        own[at:at] = other
        texts.append((500 + n, " ".join(own)))
    kept = docs.sparkSession.createDataFrame([(*r, "x", "y") for r in texts], "doc_id bigint, text string, row string, start string")
    expected = [(doc_id, *found) for doc_id, text in set(texts) for found in brute_near(text, items)]
    assert len({e[0] for e in expected if e[0] and e[0] >= 500}) > 20
    assert near_rows(find_near_passages(kept, bench)) == sorted(expected, key=str)
    expected = [(doc_id, *found) for doc_id, text in set(texts) for found in brute_near(text, items, 6, 0.7, 0)]
    assert near_rows(find_near_passages(kept, bench, 6, 0.7, 0, lists=1)) == sorted(expected, key=str)


def test_proximity_of_changed_words(spark, none):
    """Words of the benchmark that no document has do not hide a match."""
    item = prose(10, 1)
    own = item.split()
    one, two, three = list(own), list(own), list(own)
    one[4] = two[4] = two[7] = three[0] = three[4] = three[7] = "other"
    kinds = [own, one, two, three, [*own[:5], "new", "words", *own[5:]], own[::-1]]
    docs = spark.createDataFrame([(n, " ".join(k)) for n, k in enumerate(kinds)], "doc_id bigint, text string")
    bench = spark.createDataFrame([(7, item)], "item_id bigint, text string")
    near = {r.doc_id: r.most_met for r in find_near_passages(docs, bench).collect()}
    assert near == {0: 10, 1: 9, 2: 8, 4: 10}
    # The only document with the item has it with a changed word.
    assert [r.most_met for r in find_near_passages(docs.where("doc_id = 1"), bench).collect()] == [9]
    assert find_near_passages(none, bench).collect() == find_near_passages(docs, bench.where("false")).collect() == []
    with pytest.raises(ValueError):
        find_near_passages(docs, bench, share=0)


def test_near_passages_split_each_text_once(spark, monkeypatch):
    """Not in the lambdas that look words up, where it would be done for every word."""
    from dayfold.llm.tables import Scratch

    plans, write = [], Scratch.write

    def watched(self, df):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return write(self, df)

    monkeypatch.setattr(Scratch, "write", watched)
    docs = spark.createDataFrame([(1, "x " * 30 + " ".join(f"w{n}" for n in range(12)))], "doc_id bigint, text string")
    items = spark.createDataFrame([(7, " ".join(f"w{n}" for n in range(10)))], "item_id bigint, text string")
    out = find_near_passages(docs, items)
    plans.append(out._jdf.queryExecution().optimizedPlan().toString())
    assert [tuple(r) for r in out.collect()] == [(1, 7, 10, 1, 10, 28)]
    lookups = [p for p in plans if "array_contains" in p]
    assert lookups and not any("split(" in p for p in lookups)
