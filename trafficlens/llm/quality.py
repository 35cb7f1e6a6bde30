"""A quality score from a sparse ensemble of rules over text statistics.

Statistics of a text are column expressions.  A forest of shallow trees over
them proposes conjunctive rules, one for every path from a root; a logistic
regression with lasso penalty weighs the rules and drops most.  The rest are
compiled into one column expression, so scoring is a projection.

Null text is empty, whose statistics are all zero; it gets a score like any
other.  Repeated labels of a document count by their mean, rounded (half up);
null labels are ignored.  With labels of one kind only, or none, the score is the
smoothed share of label 1.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trafficlens.session import staged

# About so many labelled documents are used, taken by a hash of their id.
TRAIN_ROWS = 40_000
TREES = 20
DEPTH = 3
PENALTY = 0.002
ROUNDS = 60

# Characters counted by the statistics.
SYMBOLS = "#$%&*|@^~<>{}[]=_+/\\"
MARKS = ".,;:?"
DIGITS = "0123456789"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZÀÁÂÄÇÈÉÊËÌÍÎÏÑÒÓÔÖÙÚÛÜ"


def _share(text: Column, characters: str, size: Column) -> Column:
    """Share of the characters of a text that are among the given ones."""
    return (size - F.char_length(F.translate(text, characters, ""))) / F.greatest(size, F.lit(1))


def statistics(text: Column) -> dict[str, Column]:
    """Numbers about a text; all zero for an empty one."""
    text = F.coalesce(text, F.lit(""))
    size = F.char_length(text)
    words = F.filter(F.split(text, " "), lambda w: w != "")
    n_words = F.size(words)
    lines = F.filter(F.split(text, "\n"), lambda x: x != "")
    n_lines = F.size(lines)
    lengths = F.transform(words, lambda w: F.char_length(w))
    some_words = F.greatest(n_words, F.lit(1))
    some_lines = F.greatest(n_lines, F.lit(1))
    return {
        "log_chars": F.log1p(size.cast("double")),
        "log_words": F.log1p(n_words.cast("double")),
        "word_length": (size - n_words) / some_words,
        "longest_word": F.coalesce(F.array_max(lengths), F.lit(0)).cast("double"),
        "line_length": F.log1p(size / some_lines),
        "repeated_words": (n_words - F.size(F.array_distinct(words))) / some_words,
        "repeated_lines": (n_lines - F.size(F.array_distinct(lines))) / some_lines,
        "symbols": _share(text, SYMBOLS, size),
        "marks": _share(text, MARKS, size),
        "cries": _share(text, "!", size),
        "digits": _share(text, DIGITS, size),
        "capitals": _share(text, CAPITALS, size),
    }


STATISTICS = (
    "log_chars",
    "log_words",
    "word_length",
    "longest_word",
    "line_length",
    "repeated_words",
    "repeated_lines",
    "symbols",
    "marks",
    "cries",
    "digits",
    "capitals",
)

# A rule: bounds (statistic, above, at most) that must all hold.
Rule = tuple[tuple[str, float, float], ...]
_OPEN = float("inf")


def tree_rules(described: str) -> set[Rule]:
    """The rules of a tree from its printed form, one for every path from the root."""
    found: set[Rule] = set()
    path: list[tuple[str, float, float]] = []
    for line in described.splitlines():
        step = re.match(r"( *)(If|Else) \(feature (\d+) (<=|>) ([-+.\dE]+)\)", line)
        if not step:
            continue
        depth = len(step[1]) - 2
        name, bound = STATISTICS[int(step[3])], float(step[5])
        side = (name, -_OPEN, bound) if step[4] == "<=" else (name, bound, _OPEN)
        path = [*path[:depth], side]
        bounds: dict[str, tuple[float, float]] = {}
        for statistic, above, most in path:
            low, high = bounds.get(statistic, (-_OPEN, _OPEN))
            bounds[statistic] = (max(low, above), min(high, most))
        found.add(tuple(sorted((s, low, high) for s, (low, high) in bounds.items())))
    return found


def rule_column(rule: Rule) -> Column:
    """Whether a rule holds."""
    tests = []
    for name, above, most in rule:
        if above > -_OPEN:
            tests.append(F.col(name) > above)
        if most < _OPEN:
            tests.append(F.col(name) <= most)
    held = tests[0]
    for test in tests[1:]:
        held = held & test
    return held


@dataclass
class Model:
    intercept: float
    weights: dict[Rule, float] = field(default_factory=dict)

    def score(self) -> Column:
        """The score as an expression of the statistics' columns."""
        total = F.lit(self.intercept)
        for rule, weight in sorted(self.weights.items()):
            total = total + F.when(rule_column(rule), weight).otherwise(0.0)
        return 1 / (1 + F.exp(-total))


def fit(measured: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> Model:
    """Learn from ``measured`` (``doc_id`` and statistics) and ``labels``
    (``doc_id``, ``label`` 0 or 1)."""
    wanted = labels.filter("doc_id is not null and label is not null").groupBy("doc_id").agg(
        F.floor(F.avg("label") + 0.5).cast("double").alias("label")
    )
    held = measured.join(wanted, "doc_id")
    kinds = {r["label"]: r["n"] for r in held.groupBy("label").agg(F.count("*").alias("n")).collect()}
    total = sum(kinds.values())
    if len(kinds) < 2:
        share = (kinds.get(1.0, 0) + 1) / (total + 2)
        return Model(math.log(share / (1 - share)))
    step = max(1, round(total / train_rows))
    sample = staged(
        held.filter(F.pmod(F.xxhash64(F.lit("quality"), "doc_id"), F.lit(step)) == 0), "labelled"
    )
    gathered = VectorAssembler(inputCols=list(STATISTICS), outputCol="statistics")
    forest = RandomForestClassifier(
        featuresCol="statistics",
        labelCol="label",
        numTrees=TREES,
        maxDepth=DEPTH,
        subsamplingRate=0.5,
        featureSubsetStrategy="onethird",
        seed=5,
    ).fit(gathered.transform(sample))
    rules = sorted(set().union(*(tree_rules(tree.toDebugString) for tree in forest.trees)))
    if not rules:
        share = (kinds[1.0] + 1) / (total + 2)
        return Model(math.log(share / (1 - share)))
    held_rules = array_to_vector(F.array(*[rule_column(r).cast("double") for r in rules]))
    fitted = LogisticRegression(
        featuresCol="rules",
        labelCol="label",
        elasticNetParam=1.0,
        regParam=PENALTY,
        maxIter=ROUNDS,
    ).fit(sample.select("label", held_rules.alias("rules")))
    return Model(
        fitted.intercept,
        {rule: w for rule, w in zip(rules, fitted.coefficients.toArray().tolist()) if w},
    )


def measure(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the statistics of its text, per row."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        *[column.cast("double").alias(name) for name, column in statistics(F.col("text")).items()],
    )


def score(docs: DataFrame, labels: DataFrame, train: Column) -> DataFrame:
    """Per row of documents ``doc_id``, its statistics and ``score``; learned from
    the labels of documents where ``train``, an expression of ``doc_id``, holds."""
    measured = staged(measure(docs), "statistics")
    model = fit(measured.filter(train), labels)
    return measured.withColumn("score", model.score())
