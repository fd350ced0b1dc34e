from collections import defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st

from dayfold.llm.exact_dedup import exact_dedup


def brute(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[text or ""].append(doc_id)
    out = []
    for doc_id, text in rows:
        same = groups[text or ""]
        known = [d for d in same if d is not None]
        out.append((doc_id, max(known) if known else None, len(same)))
    return sorted(out, key=str)


def check(found, rows):
    got = found.collect()
    assert sorted([(r.doc_id, r.keep_id, r.group_size) for r in got], key=str) == brute(rows)
    assert sum(r.kept for r in got) == len({text or "" for _, text in rows})
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_odd_rows(odd, odd_rows):
    rows = [r[:2] for r in odd_rows]
    check(exact_dedup(odd), rows)
    check(exact_dedup(odd, first_bytes=1, growth=2), rows)
    check(exact_dedup(odd, store_single=False), rows)


def test_carried_columns_stay_with_their_row(odd, odd_rows):
    got = exact_dedup(odd, carry=["text", "n_chars"], store_single=False).where("kept").collect()
    assert sorted((r.text or "") for r in got) == sorted({r[1] or "" for r in odd_rows})


def test_empty_table(none):
    assert exact_dedup(none).collect() == []


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 9), st.text("ab", max_size=6)), min_size=1, max_size=30))
def test_any_rows(spark, rows):
    check(exact_dedup(spark.createDataFrame(rows, "doc_id bigint, text string"), first_bytes=1, growth=1), rows)
