import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given
from hypothesis import strategies as st
from tokenizers import Tokenizer

from dayfold.llm.packing import Encoder, best_fit_pack, best_fit_runs

PATH = public_tokenizers.path("byte_bpe_50k.json")


def ids_of(text):
    return Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids + [2]


def check_placement(rows, capacity):
    used = defaultdict(list)
    for r in rows:
        used[r.sequence_id].append((r.offset, r.length))
    for places in used.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(used)


@pytest.mark.parametrize("text", ["a  b", "a\n b \n\n  c", "\x00\t b", "x<|endoftext|> y", "É ß 漢字 🙂", " ", "a" * 5000])
def test_ids_are_the_tokenizers(text):
    assert Encoder(PATH).encode(text).tolist() == ids_of(text)[:-1]
    assert Encoder(PATH).ranked is not None


def test_odd_rows(odd, odd_rows):
    got = best_fit_pack(odd, PATH, keep_ids=True).collect()
    check_placement(got, 1024)
    pieces = defaultdict(list)
    for r in got:
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, dtype="<u4").tobytes())
        assert len(r.ids) == r.length
        pieces[r.doc_id].append((r.piece, r.start, r.ids))
    texts = defaultdict(list)
    for doc_id, text, *_ in odd_rows:
        texts[doc_id].append(ids_of(text))
    for doc_id, all_ids in texts.items():
        assert sorted(x for _, _, ids in pieces[doc_id] for x in ids) == sorted(x for ids in all_ids for x in ids)
        if len(all_ids) == 1:
            own = sorted(pieces[doc_id])
            assert [x for _, _, ids in own for x in ids] == all_ids[0]
            assert [p for p, _, _ in own] == list(range(len(own)))
            assert [s for _, s, _ in own] == [sum(len(i) for _, _, i in own[:n]) for n in range(len(own))]
            assert all(len(ids) == 1024 for _, _, ids in own[1:])


def test_few_sequences(documents):
    got = best_fit_pack(documents, PATH).collect()
    sequences = check_placement(got, 1024)
    assert sequences <= 1.02 * -(-sum(r.length for r in got) // 1024)


def test_empty_table(none):
    assert best_fit_pack(none, PATH).collect() == []


@given(st.lists(st.integers(1, 20), max_size=200))
def test_runs_are_best_fit_decreasing(lengths):
    """The number of sequences is that of best fit over single pieces, longest first."""
    counts = {n: lengths.count(n) for n in set(lengths)}
    gaps = []
    for length in sorted(lengths, reverse=True):
        fits = [g for g in gaps if g >= length]
        if fits:
            gaps.remove(min(fits))
            gaps.append(min(fits) - length)
        else:
            gaps.append(20 - length)
    assert best_fit_runs(counts, 20).sequences == len(gaps)
