"""Quality scores by a sparse ensemble of rules.

Shallow trees are grown on statistics of the texts; each path from a root is a rule, a conjunction of thresholds.
A lasso logistic regression over the rules keeps few of them with weights, and the kept rules are compiled into one
Spark column: scoring a corpus is a projection without Python.

Bound: labels are learned from at most `TRAIN_ROWS` texts, those with the smallest hash of doc_id.

Defined cases: null and empty texts have statistics of zero and get a score like any other; null labels and labels
without a text are left out; a label given twice counts once, as 1 if any says so. Without training texts of both
kinds every score is the smoothed share of label 1. Repeated rows each give a row; an empty table gives an empty
result. Only doc_id, text and the label are read.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlap.llm.common import SPACES, cut, keep, whole_row
from gridlap.llm.quality_rules import STOP_WORDS, SYMBOLS, without, words

TRAIN_ROWS, TREES, DEPTH, LASSO = 20_000, 12, 3, 2e-3
FEATURES = ("log_words", "mean_word_chars", "symbol_share", "upper_share", "mark_share", "digit_share", "stop_share", "distinct_pair_share", "echo_share", "distinct_line_share", "words_a_line")
UPPER_CASE = "ABCDEFGHIJKLMNOPQRSTUVWXYZÀÁÂÄÇÈÉÊËÍÑÓÔÖÚÜ"

#: A rule: (feature, whether at most, threshold) for each condition.
Rule = tuple[tuple[str, bool, float], ...]


def statistics(docs: DataFrame) -> DataFrame:
    """row (a struct of all columns of docs, so that no name of theirs can clash), and FEATURES of each text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    base = docs.select(whole_row(docs).alias("row"), text.alias("t"), words(text).alias("w"), F.length(without(text, SPACES)).alias("c"))
    share = lambda part, whole: F.when(whole > 0, part / whole).otherwise(F.lit(0.0))
    removed = lambda chars: F.length("t") - F.length(without(F.col("t"), chars))
    n = F.size("w")
    lines = F.split("t", "\n")
    # Pairs of words, unlike words, don't recur more in a long text than in a short one.
    pairs = F.transform(F.sequence(F.lit(0), n - 2), lambda i: F.xxhash64(F.col("w")[i], F.col("w")[i + 1]))
    return base.select(
        "row",
        F.log1p(n).alias("log_words"),
        share(F.col("c"), n).alias("mean_word_chars"),
        share(removed(SYMBOLS), F.col("c")).alias("symbol_share"),
        share(removed(UPPER_CASE), F.col("c")).alias("upper_share"),
        share(removed(".,;:!?"), F.col("c")).alias("mark_share"),
        share(removed("0123456789"), F.col("c")).alias("digit_share"),
        share(F.size(F.filter("w", lambda x: x.isin(STOP_WORDS))), n).alias("stop_share"),
        F.when(n < 2, F.lit(1.0)).otherwise(F.size(F.array_distinct(pairs)) / (n - 1)).alias("distinct_pair_share"),
        share(F.size(F.filter("w", lambda x, i: x == F.get(F.col("w"), i - 1))), n).alias("echo_share"),
        share(F.size(F.array_distinct(lines)), F.size(lines)).alias("distinct_line_share"),
        share(n, F.size(lines)).alias("words_a_line"),
    )


def _paths(node, so_far: Rule) -> list[Rule]:
    """Every path from the root down to a node below it, as a rule."""
    out = [so_far] if so_far else []
    if node.subtreeDepth() > 0:
        split = node.split()
        name, at = FEATURES[split.featureIndex()], split.threshold()
        out += _paths(node.leftChild(), (*so_far, (name, True, at)))
        out += _paths(node.rightChild(), (*so_far, (name, False, at)))
    return out


def _condition(rule: Rule) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f) <= at if low else F.col(f) > at for f, low, at in rule])


class RuleEnsemble:
    """base and weights of the kept rules; `column` compiles them."""

    def __init__(self, base: float, weights: dict[Rule, float]) -> None:
        self.base, self.weights = base, weights

    def column(self) -> Column:
        total = reduce(lambda a, rw: a + F.when(_condition(rw[0]), F.lit(rw[1])).otherwise(0.0), self.weights.items(), F.lit(self.base))
        return 1 / (1 + F.exp(-total))


def fit(train: DataFrame, seed: int = 7) -> RuleEnsemble:
    """train: doc_id, text, label (0 or 1), bounded by the caller. The rows are put in order before trees are grown, so
    the model doesn't depend on how the input lies in partitions."""
    known = train.where("label in (0, 1)").select("doc_id", "text", "label")
    found = cut(statistics(known).select("row.doc_id", F.xxhash64("row.text").alias("of"), F.col("row.label").cast("double").alias("label"), *FEATURES))
    rows = cut(found.coalesce(1).sortWithinPartitions("doc_id", "of").select("label", *FEATURES))
    n, ones = rows.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0.0))).first()
    if ones in (0, n):
        share = (ones + 1) / (n + 2)
        return RuleEnsemble(math.log(share / (1 - share)), {})
    vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(rows)
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=seed, featureSubsetStrategy="sqrt").fit(vectors)
    rules = list(dict.fromkeys(r for tree in forest.trees for r in _paths(tree._java_obj.rootNode(), ())))
    met = rows.select("label", *(_condition(r).cast("double").alias(f"r{i}") for i, r in enumerate(rules)))
    met = VectorAssembler(inputCols=[f"r{i}" for i in range(len(rules))], outputCol="rules").transform(met)
    lasso = LogisticRegression(featuresCol="rules", elasticNetParam=1.0, regParam=LASSO, standardization=False, maxIter=60).fit(met.select("label", "rules"))
    weights = {r: float(w) for r, w in zip(rules, lasso.coefficients.toArray(), strict=True) if w}
    return RuleEnsemble(float(lasso.intercept), weights)


def score(docs: DataFrame, model: RuleEnsemble) -> DataFrame:
    """doc_id, score for each row of docs."""
    return statistics(docs.select("doc_id", "text")).select("row.doc_id", model.column().alias("score"))


def keep_good(docs: DataFrame, model: RuleEnsemble) -> DataFrame:
    """The rows of docs with a score of 0.5 or more, with all their columns."""
    scored = statistics(docs).select("row", model.column().alias("score"))
    return keep(scored, F.col("score") >= 0.5).select("row.*")
