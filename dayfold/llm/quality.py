"""Quality scores by a sparse ensemble of rules over text statistics."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayfold.llm.tables import Scratch, known_text, need

STATISTICS = (
    "chars",
    "words",
    "word_length",
    "distinct_words",
    "lines",
    "distinct_lines",
    "line_length",
    "letters",
    "capitals",
    "digits",
    "symbols",
    "stops",
    "commas",
    "shouts",
    "bars",
    "line_ends",
)


def with_statistics(docs: DataFrame, text_col: str = "text", keep: Sequence[str] = ()) -> DataFrame:
    """The columns of ``keep`` and the statistics of every whole text, in columns ``s_...``.

    Counts are logarithms, the others shares of the characters, words or lines; all
    are 0 for NULL and empty text.
    """
    text, chars = F.col("__text"), F.length("__text")
    rows = docs.select(*keep, known_text(text_col).alias("__text")).select(
        *keep, "__text", F.split("__text", " ").alias("__words"), F.split("__text", "\n").alias("__lines")
    )

    def share(part: Column, of: Column) -> Column:
        return F.when(of > 0, part / of).otherwise(0.0)

    def only(others: str) -> Column:
        return share(F.length(F.regexp_replace(text, others, "")), chars)

    def of(character: str) -> Column:
        return share(chars - F.length(F.replace(text, F.lit(character), F.lit(""))), chars)

    words, lines = F.size("__words"), F.size("__lines")
    ended = F.size(F.filter("__lines", lambda line: F.substring(F.rtrim(line), -1, 1).isin(".", "!", "?", ":")))
    values = {
        "chars": F.log1p(chars),
        "words": F.log1p(words),
        "word_length": share(chars.cast("double"), words),
        "distinct_words": share(F.size(F.array_distinct("__words")), words),
        "lines": F.log1p(lines),
        "distinct_lines": share(F.size(F.array_distinct("__lines")), lines),
        "line_length": F.log1p(share(chars.cast("double"), lines)),
        "letters": only(r"[^\p{L}]+"),
        "capitals": only(r"[^A-ZÀ-ÖØ-Þ]+"),
        "digits": only(r"[^0-9]+"),
        "symbols": only(r"[\p{L}\p{N}\s.,;:]+"),
        "stops": of("."),
        "commas": of(","),
        "shouts": of("!"),
        "bars": of("|"),
        "line_ends": share(ended, lines),
    }
    return rows.select(*keep, *[values[s].cast("double").alias(f"s_{s}") for s in STATISTICS])


# One condition: statistic, whether at most (else more than), threshold.
Condition = tuple[str, bool, float]
Rule = frozenset[Condition]


def _holds(rule: Rule) -> Column:
    return reduce(
        lambda a, b: a & b,
        [F.col(f"s_{s}") <= t if at_most else F.col(f"s_{s}") > t for s, at_most, t in sorted(rule)],
    )


@dataclass
class RuleEnsemble:
    """Rules with their logistic weights; ``score`` is one Spark expression over the statistics."""

    intercept: float = 0.0
    rules: dict[Rule, float] = field(default_factory=dict)

    def score(self) -> Column:
        weights = [F.when(_holds(rule), F.lit(w)).otherwise(0.0) for rule, w in self.rules.items()]
        return 1.0 / (1.0 + F.exp(-reduce(lambda a, b: a + b, weights, F.lit(self.intercept))))


def _paths(node, so_far: Rule = frozenset()) -> list[Rule]:
    """The rule of every node below the root of a fitted tree."""
    if node.subtreeDepth() == 0:
        return []
    split, out = node.split(), []
    name = STATISTICS[split.featureIndex()]
    for child, at_most in ((node.leftChild(), True), (node.rightChild(), False)):
        rule = so_far | {(name, at_most, float(split.threshold()))}
        out += [rule, *_paths(child, rule)]
    return out


def fit_rules(
    docs: DataFrame,
    labels: DataFrame,
    label_col: str = "quality",
    id_col: str = "doc_id",
    text_col: str = "text",
    train: Column | None = None,
    most_rows: int = 20_000,
    trees: int = 12,
    depth: int = 3,
    penalty: float = 0.002,
    seed: int = 7,
) -> RuleEnsemble:
    """Fit a rule ensemble on labelled texts.

    A forest of shallow trees is grown on the statistics; the path to each of its nodes
    is a rule, a conjunction of thresholds. Logistic regression with a lasso penalty
    on the rules' outcomes keeps the few with a weight.

    ``most_rows`` bounds the labelled rows used for fitting: those with the smallest hashes
    of their ids, of all for which ``train`` (over the id column) holds. An id labelled several times
    counts once, with its mean label rounded up from one half; NULL ids and labels are left out. Without rows
    of both labels, the ensemble has no rules and scores by the share of label 1,
    smoothed by one row of each (0.5 without rows).
    """
    from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler

    need(docs, [id_col, text_col])
    need(labels, [id_col, label_col])
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
    if train is not None:
        known = known.where(train)
    known = known.groupBy(id_col).agg((F.avg(label_col) >= 0.5).cast("double").alias("label"))
    sample = known.orderBy(F.xxhash64(id_col), id_col).limit(most_rows)
    scratch = Scratch(docs.sparkSession, "quality")
    sample = scratch.write(sample)
    # At most `most_rows` ids and labels.
    texts = docs.select(id_col, text_col).join(F.broadcast(sample), id_col)
    rows = scratch.write(with_statistics(texts, text_col, ["label"]))
    ones, n = rows.agg(F.sum("label"), F.count(F.lit(1))).first()
    ones = ones or 0.0
    if not 0 < ones < n:
        return RuleEnsemble(_logit((ones + 1) / (n + 2)))

    assemble = VectorAssembler(inputCols=[f"s_{s}" for s in STATISTICS], outputCol="features")
    features = assemble.transform(rows).select("features", "label", *rows.columns[1:]).coalesce(8).cache()
    forest = RandomForestClassifier(
        numTrees=trees, maxDepth=depth, featureSubsetStrategy="onethird", seed=seed, minInstancesPerNode=5
    ).fit(features)
    found = sorted({r for t in forest.trees for r in _paths(t._java_obj.rootNode())}, key=sorted)
    if not found:
        features.unpersist()
        return RuleEnsemble(_logit((ones + 1) / (n + 2)))
    outcomes = features.select("label", *[_holds(r).cast("double").alias(f"r{i}") for i, r in enumerate(found)])
    assemble = VectorAssembler(inputCols=outcomes.columns[1:], outputCol="features")
    # A weight for each label, so that the rarer one is not written off.
    balance = F.when(F.col("label") == 1.0, n / (2 * ones)).otherwise(n / (2 * (n - ones)))
    outcomes = assemble.transform(outcomes).select("features", "label", balance.alias("weight"))
    model = LogisticRegression(
        elasticNetParam=1.0, regParam=penalty, maxIter=40, standardization=False, weightCol="weight"
    ).fit(outcomes)
    features.unpersist()
    weights = {r: w for r, w in zip(found, model.coefficients.toArray().tolist()) if w}
    return RuleEnsemble(float(model.intercept), weights)


def _logit(p: float) -> float:
    import math

    return math.log(p / (1 - p))


def score_quality(
    docs: DataFrame, ensemble: RuleEnsemble, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``score`` (0 to 1) and ``predicted`` of every whole text, by Spark expressions alone.

    NULL counts as empty text, which has statistics of its own and so a score. Repeated
    rows are scored each; other columns are ignored; an empty table gives no rows.
    """
    need(docs, [id_col, text_col])
    rows = with_statistics(docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__in")), "__in", ["__id"])
    scored = rows.select(F.col("__id").alias(id_col), ensemble.score().alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
