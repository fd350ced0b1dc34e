import numpy as np
import pytest

from dayfold.llm.catalog import QUERIES
from dayfold.llm.langid import TextModel, fit_text_model, identify_languages, page_evidence


@pytest.fixture(scope="module")
def sample(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")


def test_declared_languages_of_held_out_rows(sample):
    model = fit_text_model(sample.where("doc_id % 3 = 0"), "lang")
    assert model.languages == ["de", "en", "es", "fr"]
    rest = sample.where("doc_id % 3 <> 0")
    got = identify_languages(rest, model=model, carry=["lang"]).collect()
    assert len(got) == rest.count()
    assert sum(r.language == r.lang for r in got) / len(got) > 0.95
    assert all(r.accepted for r in got)


def test_posterior_of_short_texts_against_the_formula(spark):
    """Counts, smoothing and fusion worked out by hand for one declared value, suffix and host."""
    table = np.log(np.full((1 << 15, 2), 1.0 / (1 << 15)))
    from dayfold.llm.langid import _trigrams

    table[_trigrams("aaa"), 0] += 1.0
    table[_trigrams("bbb"), 1] += 1.0
    model = TextModel(["x", "y"], table)
    rows = [("aaa", "x", "com", "h.a.org")] * 6 + [("bbb", "y", "de", "g.a.org")] * 2 + [("ccc", "y", "de", "h.a.org")]
    docs = spark.createDataFrame([(n, *r) for n, r in enumerate(rows)], "doc_id int, text string, lang string, suffix string, host string")
    got = identify_languages(docs, suffix_col="suffix", host_col="host", model=model, weight=2.0).collect()
    last = next(r for r in got if r.doc_id == 8)

    best = [model.likelihoods(r[0])[0] for r in rows]
    reads = [int(np.argmax(b)) for b in best]  # the even text counts for the first language
    total = np.array([reads.count(0), reads.count(1)], dtype=float)
    world = (total + 1) / (total.sum() + 2)

    def counts(column, value):
        return np.array([sum(1 for r, k in zip(rows, reads) if r[column] == value and k == i) for i in (0, 1)], dtype=float)

    domain = (total + 2 * world) / (total.sum() + 2)
    here = counts(3, "h.a.org")
    prior = (here + 2 * domain) / (here.sum() + 2)
    logs = best[8] * 0.3 + np.log(prior)
    for column, value in ((1, "y"), (2, "de")):
        n = counts(column, value)
        logs += np.log((n + 2 * n.sum() / (total.sum() + 1)) / (total + 2))
    odds = np.exp(logs - logs.max())
    assert last.language == "xy"[int(np.argmax(logs))]
    assert last.probability == pytest.approx(odds.max() / odds.sum())


def test_pages(spark):
    """Menus and footers of these pages are often in another language than the article."""
    got = QUERIES["page_languages"](spark, "/root/testdata/sf0.01").collect()
    assert len(got) == 250 and all(r.host and r.host.endswith(r.suffix or "") for r in got)
    assert sum(r.language == r.declared for r in got) > 0.9 * 250
    odd = [("http://A.Example.DE:80/x", '<HTML dir=ltr LANG="De-ch"><style>x</style><p>y'), (None, None), ("x", "<p lang=en>")]
    found = page_evidence(spark.createDataFrame(odd, "url string, html string")).collect()
    assert [(r.declared, r.suffix, r.host) for r in found] == [("de", "de", "a.example.de"), (None, None, None), (None, None, None)]
    assert found[0].plain.split() == ["y"]


def test_odd_rows(spark, odd, odd_rows, none):
    odd = odd.drop("language")
    model = TextModel(["en", "fr"], np.log(np.full((1 << 15, 2), 1.0 / (1 << 15))))
    got = identify_languages(odd, model=model).collect()
    assert len(got) == len(odd_rows)
    assert all((r.text_language is not None) >= r.accepted for r in got)
    assert sum(r.text_language is None for r in got) == sum(1 for r in odd_rows if not (r[1] or "").strip(" \x00\x1f\x7f"))
    # No declared value has enough texts to be a language.
    assert {r.language for r in identify_languages(odd).collect()} == {"und"}
    assert identify_languages(none, model=model).collect() == identify_languages(none).collect() == []


def test_many_declared_values_stay_on_the_executors(spark):
    """Values that few rows declare are counted and left; of the others a bounded sample is read."""
    rare = spark.range(100_000).selectExpr("id AS doc_id", "concat('x', id) AS lang", "'abc def' AS text")
    common = spark.range(40_000).selectExpr("id + 200000 AS doc_id", "IF(id % 2 = 0, 'aa', 'bb') AS lang", "IF(id % 2 = 0, 'aba', 'bcb') AS text")
    model = fit_text_model(rare.unionByName(common), "lang")
    assert model.languages == ["aa", "bb"]
    names = [f"l{n:02}" for n in range(12)]
    few = spark.range(1200).selectExpr("id AS doc_id", "concat('l', lpad(id % 12, 2, '0')) AS lang", "'abc' AS text")
    assert fit_text_model(few, "lang").languages == names
    assert fit_text_model(few.unionByName(few), "lang", most_languages=5).languages == names[:5]
    assert fit_text_model(few.where("false"), "lang").languages == []
