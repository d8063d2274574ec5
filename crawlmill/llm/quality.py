"""Quality classifier: a sparse ensemble of conjunctive rules over text statistics.

Shallow trees are grown on the statistics of labelled rows; every path from a root is a rule, that
is, a conjunction of thresholds. A logistic regression with lasso weighs the rules and leaves most
out. What is left is compiled into one Spark column expression, so scoring needs nothing but SQL
functions, in one pass over the texts.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator
from dataclasses import dataclass, field

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlmill.llm.common import text_or_empty
from crawlmill.session import materialize

SAMPLE = 20_000  # labelled rows at most that the model is fitted on
TREES = 24
DEPTH = 3
LASSO = 0.002
FOLDS = 5
CUTOFF = 0.3

STATISTICS = (
    "log_words", "word_length", "distinct_words", "distinct_lines", "letters", "upper", "digits",
    "blanks", "marks", "symbols", "bare_marks", "long_words",
)


def _count_kept(text: Column, dropped: str) -> Column:
    return F.length(F.regexp_replace(text, dropped, ""))


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(0.0)


def with_statistics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with a struct ``stats`` of all STATISTICS; a null or empty text has zeros only."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    counted = docs.withColumn(
        "counts",
        F.struct(
            F.length(text).alias("chars"),
            _count_kept(text, r"\P{L}++").alias("letters"),
            _count_kept(text, r"\P{Lu}++").alias("upper"),
            _count_kept(text, r"[^0-9]++").alias("digits"),
            _count_kept(text, r"\S++").alias("blanks"),
            _count_kept(text, r"[^.,;:?'\"()-]++").alias("marks"),
            F.regexp_count(text, F.lit(r"(?<!\S)[^\p{L}\p{N}\s]++(?!\S)")).alias("bare"),
            F.regexp_count(text, F.lit(r"\S{20}\S*+")).alias("long"),
            F.filter(F.split(text, r"\s+"), lambda w: w != "").alias("words"),
            F.filter(F.split(text, "\n"), lambda line: line != "").alias("lines"),
        ),
    )
    c = lambda name: F.col(f"counts.{name}")
    words, lines = F.size(c("words")), F.size(c("lines"))
    solid = c("chars") - c("blanks")
    values = {
        "log_words": F.log1p(words),
        "word_length": _share(solid, words),
        "distinct_words": _share(F.size(F.array_distinct(c("words"))), words),
        "distinct_lines": _share(F.size(F.array_distinct(c("lines"))), lines),
        "letters": _share(c("letters"), solid),
        "upper": _share(c("upper"), c("letters")),
        "digits": _share(c("digits"), solid),
        "blanks": _share(c("blanks"), c("chars")),
        "marks": _share(c("marks"), solid),
        "symbols": _share(solid - c("letters") - c("digits") - c("marks"), solid),
        "bare_marks": _share(c("bare"), words),
        "long_words": _share(c("long"), words),
    }
    return counted.withColumn("stats", F.struct(*[values[s].cast("double").alias(s) for s in STATISTICS])).drop("counts")


@dataclass(frozen=True)
class Rule:
    """All bounds hold: (statistic, is an upper bound, threshold)."""

    bounds: tuple[tuple[str, bool, float], ...]

    def column(self, stats: str = "stats") -> Column:
        tests = [
            F.col(f"{stats}.{name}") <= at if upper else F.col(f"{stats}.{name}") > at for name, upper, at in self.bounds
        ]
        return functools.reduce(lambda a, b: a & b, tests)

    def holds(self, stats: dict[str, float]) -> bool:
        return all((stats[name] <= at) == upper for name, upper, at in self.bounds)

    def and_bound(self, name: str, upper: bool, at: float) -> Rule:
        """With one more bound; of two on the same side the tighter one counts."""
        kept = {(n, u): a for n, u, a in self.bounds}
        old = kept.get((name, upper), at)
        kept[name, upper] = min(old, at) if upper else max(old, at)
        return Rule(tuple((n, u, a) for (n, u), a in sorted(kept.items())))


@dataclass(frozen=True)
class RuleEnsemble:
    """score = 1 / (1 + exp(-(intercept + sum of the weights of the rules that hold)))."""

    intercept: float
    weights: dict[Rule, float] = field(default_factory=dict)

    def score(self, stats: str = "stats") -> Column:
        total = F.lit(self.intercept)
        for rule, weight in self.weights.items():
            total = total + F.when(rule.column(stats), weight).otherwise(0.0)
        return 1.0 / (1.0 + F.exp(-total))


def _paths(node, rule: Rule = Rule(())) -> Iterator[Rule]:
    if rule.bounds:
        yield rule
    if node.subtreeDepth() > 0:
        name, at = STATISTICS[node.split().featureIndex()], float(node.split().threshold())
        yield from _paths(node.leftChild(), rule.and_bound(name, True, at))
        yield from _paths(node.rightChild(), rule.and_bound(name, False, at))


def fit(
    labelled: DataFrame, label_col: str = "label", trees: int = TREES, depth: int = DEPTH, lasso: float = LASSO
) -> RuleEnsemble:
    """The ensemble for rows with ``stats`` and a 0/1 label.

    Rows without a label are left out. With one class only (or no rows) the score is the share of
    label 1 with one half added to either class.
    """
    counts = {r[0]: r[1] for r in labelled.filter(F.col(label_col).isin(0, 1)).groupBy(label_col).count().collect()}
    prior = math.log((counts.get(1, 0) + 0.5) / (counts.get(0, 0) + 0.5))
    if len(counts) < 2:
        return RuleEnsemble(prior)
    rows = labelled.filter(F.col(label_col).isin(0, 1)).select(F.col(label_col).cast("double").alias("label"), "stats")
    flat = VectorAssembler(inputCols=list(STATISTICS), outputCol="features").transform(rows.select("label", "stats.*"))
    forest = RandomForestClassifier(
        numTrees=trees, maxDepth=depth, featureSubsetStrategy="onethird", seed=1, minInstancesPerNode=5
    ).fit(flat.select("label", "features"))
    rules = list(dict.fromkeys(r for tree in forest.trees for r in _paths(tree._call_java("rootNode"))))
    if not rules:
        return RuleEnsemble(prior)
    held = rows.select("label", *[r.column().cast("double").alias(f"r{i}") for i, r in enumerate(rules)])
    held = VectorAssembler(inputCols=[f"r{i}" for i in range(len(rules))], outputCol="features").transform(held)
    held = materialize(held.select("label", "features"), "rules")
    weighed = LogisticRegression(regParam=lasso, elasticNetParam=1.0, maxIter=100).fit(held)
    weights = {r: float(w) for r, w in zip(rules, weighed.coefficients) if w}
    return RuleEnsemble(float(weighed.intercept), weights)


def held_out(id_col: str, folds: int = FOLDS) -> Column:
    """Whether a row is kept from training."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % folds == 0, F.lit(False))


def training_rows(
    docs: DataFrame, labels: DataFrame, label: str, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE
) -> DataFrame:
    """Statistics and label of at most ``sample`` labelled rows outside the held-out fold.

    The sample takes the rows with the least hash of their id. Its ids are at most ``sample`` rows
    of a number each, so they are broadcast, and only texts of the sample are looked at.
    """
    chosen = labels.filter(~held_out(id_col) & F.col(id_col).isNotNull() & F.col(label).isin(0, 1))
    chosen = chosen.select(F.col(id_col).alias("id"), F.col(label).alias("label"))
    chosen = materialize(chosen.orderBy(F.xxhash64("id"), "id", "label").limit(sample), "sample")
    texts = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text")).join(F.broadcast(chosen), "id")
    return materialize(with_statistics(texts).select("label", "stats"), "training")


def score_quality(
    docs: DataFrame, labels: DataFrame, label: str = "quality", id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``docs`` with held_out, score (0 to 1, higher: label 1 likelier) and predicted (score >= 0.3).

    Learns from ``labels`` (id, label) outside the held-out fold; id and other columns are no inputs
    of a score. Null and empty texts get the score of all-zero statistics. Rows that repeat get equal
    scores. A null id is not held out. Columns of ``docs`` with the names of the three new ones are
    replaced. Without labels all scores are one half.
    """
    model = fit(training_rows(docs, labels, label, id_col, text_col))
    # A name of our own, so that no column of the documents is overwritten.
    plain = docs.drop("held_out", "score", "predicted")
    rows = plain.select(F.struct(*plain.columns).alias("row"), F.col(text_col).alias("text"))
    scored = with_statistics(rows).select("row", model.score().alias("score"))
    return scored.select("row.*", held_out(f"row.{id_col}").alias("held_out"), "score", (F.col("score") >= CUTOFF).cast("int").alias("predicted"))
