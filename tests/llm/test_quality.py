import pytest
from pyspark.sql import functions as F

from dayfold.llm.catalog import QUERIES
from dayfold.llm.quality import RuleEnsemble, fit_rules, score_quality, with_statistics


@pytest.fixture(scope="module")
def scored(spark):
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    return QUERIES["op1_quality_classifier"](spark, folder).join(labels, "doc_id").collect()


def test_held_out_accuracy(scored):
    own = [(r.score, r.quality) for r in scored if r.held_out]
    good, bad = ([s for s, q in own if q == label] for label in (1, 0))
    wins = sum((g > b) + 0.5 * (g == b) for g in good for b in bad) / (len(good) * len(bad))
    assert wins > 0.9
    assert sum((s >= 0.5) == q for s, q in own) / len(own) > 0.9


def test_predictions_follow_scores(scored):
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in scored)


def test_rules_as_columns(odd):
    """The compiled score equals the sum over rules that hold."""
    rules = {
        frozenset({("chars", False, 1.0), ("symbols", True, 0.1)}): 1.5,
        frozenset({("capitals", False, 0.5)}): -2.0,
    }
    ensemble = RuleEnsemble(0.25, rules)
    rows = with_statistics(odd.select("doc_id", "text"), "text", ["doc_id"]).withColumn("score", ensemble.score())
    for r in rows.collect():
        holds = [all((r[f"s_{s}"] <= t) == at_most for s, at_most, t in rule) for rule in rules]
        total = 0.25 + sum(w for w, h in zip(rules.values(), holds) if h)
        assert r.score == pytest.approx(1 / (1 + 2.718281828459045**-total))


def test_odd_rows_and_labels(spark, odd, odd_rows):
    labels = spark.createDataFrame(
        [(n, n % 2, "x") for n in range(12)] + [(None, 1, "x"), (3, None, "x"), (3, 1, "x")],
        "doc_id bigint, quality int, text string",
    )
    got = score_quality(odd, fit_rules(odd, labels)).collect()
    assert len(got) == len(odd_rows) and all(0 <= r.score <= 1 for r in got)
    for few in (labels.where("false"), labels.where("quality = 1")):
        ensemble = fit_rules(odd, few)
        assert not ensemble.rules
        scores = {round(r.score, 6) for r in score_quality(odd, ensemble).collect()}
        assert len(scores) == 1 and scores <= {0.5} if few.isEmpty() else min(scores) > 0.5


def test_the_sample_is_bounded(spark, odd):
    labels = odd.where("doc_id IS NOT NULL").select("doc_id", (F.col("doc_id") % 2).alias("quality"))
    assert isinstance(fit_rules(odd, labels, most_rows=3), RuleEnsemble)


def test_empty_table(none):
    assert score_quality(none, RuleEnsemble()).collect() == []
