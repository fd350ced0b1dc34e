import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer, models

from dayfold.llm.token_counts import SPACE, Counter, Vocabulary, count_tokens, read_vocabulary

PATH = public_tokenizers.path("piece_bpe_32k.model")


def reference(vocabulary):
    """The tokenizers library's own search over the same pieces; unknown runs count as bytes or once."""
    pieces = sorted(vocabulary.scores.items())
    model = Tokenizer(models.Unigram([("<unk>", 0.0), *pieces], 0, False))
    known = dict(pieces)

    def count(text):
        if not text:
            return 0
        tokens = model.encode(SPACE + text.replace(" ", SPACE)).tokens
        if not vocabulary.bytes_fallback:
            return len(tokens)
        return sum(1 if t in known else len(t.encode()) for t in tokens)

    return count


def test_whole_texts(documents, odd):
    count = reference(read_vocabulary(PATH))
    docs = documents.select("doc_id", "text").union(odd.select("doc_id", "text"))
    texts = docs.collect()
    got = count_tokens(docs, PATH).collect()
    assert sorted([(r.doc_id, r.n_tokens) for r in got], key=str) == sorted(
        [(r.doc_id, count(r.text)) for r in texts], key=str
    )


def test_empty_table(none):
    assert count_tokens(none, PATH).collect() == []


# Whole scores make ties, and a piece with an inner blank forbids cutting at blanks.
SMALL = {"a": -1.0, "b": -1.0, "ab": -2.0, "ba": -2.0, "aba": -3.0, SPACE: -1.0, f"{SPACE}a": -2.0, f"b{SPACE}a": -3.0}


@settings(max_examples=300)
@given(st.text("abc é", max_size=12), st.booleans(), st.booleans())
def test_ties_and_unknown_characters(text, bytes_fallback, inner):
    scores = {p: s for p, s in SMALL.items() if inner or SPACE not in p[1:]}
    vocabulary = Vocabulary(scores, bytes_fallback)
    assert vocabulary.breaks_at_spaces is not inner
    assert Counter(vocabulary).count(text)[0] == reference(vocabulary)(text)


def test_texts_without_blanks_are_not_remembered():
    vocabulary = read_vocabulary(PATH)
    counter, count = Counter(vocabulary), reference(vocabulary)
    texts = ["".join(chr(97 + (n * k) % 23) for k in range(2000)) for n in range(1, 30)]
    for text in texts:
        assert counter.count(f"{text} of words")[0] == count(f"{text} of words")
    assert sum(map(len, counter.known)) < 100
