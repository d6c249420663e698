"""Text quality by a sparse ensemble of rules over text statistics."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from dataclasses import dataclass
from functools import reduce
from operator import add, eq

import numpy as np
import pandas as pd
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.learning import MAX_LABELLED, constant_score, held_out, labelled_sample
from tallyloom.llm.storage import fresh, stored

_DIGITS = b"0123456789"
_SENTENCE = b".,;:!?'\"()-"
_ODD = b"#$%&*+/<=>@[\\]^_`{|}~"
_ODD_TEXT = frozenset(_ODD.decode())

STATISTICS = (
    "log_words", "word_length", "longest_word", "distinct_words", "commonest_word", "repeated_words",
    "upper_words", "letter_words", "single_letters", "odd_endings", "exclaiming", "digits", "sentence_signs",
    "odd_signs", "repeated_lines", "words_per_line", "compressed",
)


def statistics(text: str | None) -> tuple[float, ...]:
    """Shares and means of a whole text, in the order of ``STATISTICS``; zeros where it has no words."""
    text = text or ""
    words = text.split()
    if not words:
        return (0.0,) * len(STATISTICS)
    count, octets = len(words), text.encode()
    size = len(octets)

    def share(signs: bytes) -> float:
        return (size - len(octets.translate(None, signs))) / size

    counts = Counter(words)
    lines = [line for line in text.split("\n") if line.strip()]
    lengths = list(map(len, words))
    return (
        float(np.log1p(count)),
        sum(lengths) / count,
        float(np.log1p(max(lengths))),
        len(counts) / count,
        max(counts.values()) / count,
        sum(map(eq, words, words[1:])) / count,
        sum(map(str.isupper, words)) / count,
        sum(map(str.isalpha, words)) / count,
        lengths.count(1) / count,
        sum([word[-1] in _ODD_TEXT for word in words]) / count,
        sum([word[-1] == "!" for word in words]) / count,
        share(_DIGITS),
        share(_SENTENCE),
        share(_ODD),
        1 - len(set(lines)) / len(lines),
        float(np.log1p(count / len(lines))),
        min(1.0, len(zlib.compress(octets, 1)) / size),
    )


def with_statistics(frame: DataFrame, text_column: str, name: str) -> DataFrame:
    """All rows and columns, with a struct of the text's statistics."""

    @F.pandas_udf(", ".join(f"{x} double" for x in STATISTICS))
    def measured(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([statistics(x) for x in texts], columns=list(STATISTICS), dtype=float)

    return frame.withColumn(name, measured(text_column))


@dataclass(frozen=True)
class Rule:
    """A conjunction of (statistic, whether above, threshold), sorted."""

    tests: tuple[tuple[str, bool, float], ...]

    def column(self, statistics_column: str) -> Column:
        def test(name: str, above: bool, threshold: float) -> Column:
            value = F.col(statistics_column)[name]
            return value > threshold if above else value <= threshold

        return reduce(lambda a, b: a & b, (test(*x) for x in self.tests))


@dataclass(frozen=True)
class RuleModel:
    """A weight for each rule that the lasso keeps, and the intercept."""

    rules: tuple[tuple[Rule, float], ...]
    intercept: float

    def score(self, statistics_column: str) -> Column:
        """The probability of label 1 as one column expression."""
        weighted = [F.when(rule.column(statistics_column), weight).otherwise(0.0) for rule, weight in self.rules]
        return 1 / (1 + F.exp(-reduce(add, weighted, F.lit(self.intercept))))


_TEST = re.compile(r"^( *)(?:If|Else) \(feature (\d+) (<=|>) ([^)]+)\)")


def tree_rules(description: str, names: tuple[str, ...] = STATISTICS) -> list[Rule]:
    """The paths to all nodes of a forest, from its printed trees.

    Of several tests of a statistic in the same direction the tightest is kept.
    """
    rules, path = [], []
    for line in description.splitlines():
        found = _TEST.match(line)
        if not found:
            continue
        indent, feature, sign, threshold = len(found[1]), int(found[2]), found[3], float(found[4])
        while path and path[-1][0] >= indent:
            path.pop()
        path.append((indent, (names[feature], sign == ">", threshold)))
        tightest: dict[tuple[str, bool], float] = {}
        for _, (name, above, value) in path:
            known = tightest.setdefault((name, above), value)
            tightest[name, above] = max(known, value) if above else min(known, value)
        rules.append(Rule(tuple(sorted((n, a, v) for (n, a), v in tightest.items()))))
    return list(dict.fromkeys(rules))


def fit_rules(
    sample: DataFrame, trees: int = 24, depth: int = 3, penalty: float = 0.002, seed: int = 11
) -> RuleModel:
    """Rules from a forest's paths, weighted by logistic regression with an absolute penalty.

    ``sample`` has text and label. Where one label is missing, the model is a constant.
    """
    constant = constant_score(sample)
    if constant is not None:
        return RuleModel((), float(np.log(constant / (1 - constant))))
    measured = stored(with_statistics(sample, "text", "stats").select("label", "stats"))
    table = measured.select(
        "label", array_to_vector(F.array(*(F.col("stats")[x] for x in STATISTICS))).alias("features")
    )
    forest = RandomForestClassifier(
        numTrees=trees, maxDepth=depth, maxBins=64, subsamplingRate=0.7, labelCol="label", seed=seed
    ).fit(table)
    rules = tree_rules(forest.toDebugString)
    if not rules:
        share = table.agg(F.avg("label")).first()[0]
        return RuleModel((), float(np.log(share / (1 - share))))
    holds = F.array(*(rule.column("stats").cast("double") for rule in rules))
    fired = stored(measured.select("label", holds.alias("holds"))).select(
        "label", array_to_vector("holds").alias("features")
    )
    lasso = LogisticRegression(
        labelCol="label", elasticNetParam=1.0, regParam=penalty, maxIter=60, standardization=False
    ).fit(fired)
    kept = [(rule, float(w)) for rule, w in zip(rules, lasso.coefficients.toArray()) if w]
    return RuleModel(tuple(kept), float(lasso.intercept))


def train(
    documents: DataFrame, labels: DataFrame, label: str = "quality", max_labelled: int = MAX_LABELLED
) -> RuleModel:
    return fit_rules(labelled_sample(documents, labels, label, max_labelled))


def scored(
    documents: DataFrame, model: RuleModel, threshold: float = 0.3, text_column: str = "text"
) -> tuple[DataFrame, dict[str, str]]:
    """All rows and columns, with ``score`` and ``predicted``; renamed where the names are taken."""
    s, p, m = fresh(documents, "score", "predicted", "statistics")
    marked = with_statistics(documents, text_column, m).withColumn(s, model.score(m))
    marked = marked.withColumn(p, (F.col(s) >= threshold).cast("int")).drop(m)
    return marked, {"score": s, "predicted": p}


def quality_scores(
    documents: DataFrame,
    labels: DataFrame,
    threshold: float = 0.3,
    max_labelled: int = MAX_LABELLED,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document.

    A null or empty text has all statistics zero and is scored like any other. Null
    ids are never held out; repeated rows get equal scores. Without labels of both
    kinds every score is the smoothed share of label 1. An empty table gives no rows.
    """
    rows = documents.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    marked, names = scored(rows, train(rows, labels, max_labelled=max_labelled), threshold)
    return marked.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        F.col(names["score"]).alias("score"),
        F.col(names["predicted"]).alias("predicted"),
    )


def keep_good(
    documents: DataFrame, labels: DataFrame, threshold: float = 0.3, max_labelled: int = MAX_LABELLED
) -> DataFrame:
    """The documents predicted to be good; columns and texts unchanged."""
    marked, names = scored(documents, train(documents, labels, max_labelled=max_labelled), threshold)
    columns = [F.col(f"`{column}`") for column in documents.columns]
    return marked.where(F.col(names["predicted"]) == 1).select(*columns)
