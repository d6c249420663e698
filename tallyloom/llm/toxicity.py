"""Toxicity of texts, scored after disguised words are restored."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.char_model import BORDER, LETTERS, CharModel, plain, trigram_counts
from tallyloom.llm.learning import MAX_LABELLED, constant_score, held_out, labelled_sample
from tallyloom.llm.storage import stored

#: Letters that a sign may stand for.
LOOKALIKES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "§": "s", "¡": "i",
}
#: Signs that may stand between the letters of a word.
SEPARATORS = "._-*~'`,:;/\\#^​‌‍­"
#: Log costs of the channel: a sign for a letter, a dropped separator, a dropped or kept sign, a repetition.
SUBSTITUTED, SEPARATED, DROPPED, REPEATED = -1.0, -0.3, -12.0, -2.5
#: Log costs of a gap between spaced-out letters: dropped, or the end of a word.
GAP_DROPPED, GAP_KEPT = -0.3, -2.0
_EDGES = ".,;:!?\"'()[]{}*#%&$-_|+<>=~`"
_STOPS = frozenset(".,;:?")
_STRETCHED = re.compile(r"(.)\1\1", re.DOTALL)
_SPACED = re.compile(r"(?<!\S)\S(?:\s+\S){2,}(?!\S)")
_MAYBE_SPACED = re.compile(r"\s\S\s+\S(?!\S)|^\S\s+\S(?!\S)")
#: Stands for a gap in a lattice.
GAP = " "


def lattice(word: str) -> list[list[tuple[str, float]]]:
    """For each run of equal characters, what it may stand for and the channel's log probability.

    White space is a gap: it may be dropped, or end a word.
    """
    arcs = []
    for character, run in groupby(plain(word), key=lambda c: GAP if c.isspace() else c):
        times = len(list(run))
        options = []
        if character == GAP:
            options += [("", GAP_DROPPED), (GAP, GAP_KEPT)]
        elif character in LETTERS:
            options.append((character * min(times, 2), 0.0 if times < 3 else REPEATED))
            if times > 1:
                options.append((character, REPEATED))
        else:
            for letter in LOOKALIKES.get(character, ""):
                options.append((letter, SUBSTITUTED))
                if times > 1:
                    options.append((letter * 2, SUBSTITUTED))
            options.append(("", SEPARATED if character in SEPARATORS else DROPPED))
        arcs.append(options)
    return arcs


def restored(word: str, model: CharModel) -> str:
    """The likeliest letters behind a word: Viterbi decoding of its lattice under the model.

    A state is the last two letters, so the work is linear in the word's length. Where a
    gap ends a word, its border is one more letter and the next word starts anew; the
    words come out with a blank between them.
    """
    log = model.log
    states = {BORDER * 2: (0.0, None)}  # last letters: log probability and the letters before, linked
    for options in lattice(word):
        following = {}
        for state, (score, letters) in states.items():
            for text, cost in options:
                total, end, chain = score + cost, state, letters
                if text == GAP:
                    total, end, chain = total + log[end, BORDER], BORDER * 2, (GAP, chain)
                else:
                    for letter in text:
                        total += log[end, letter]
                        end = end[1] + letter
                        chain = (letter, chain)
                if end not in following or total > following[end][0]:
                    following[end] = (total, chain)
        states = following
    best = max(states.items(), key=lambda item: item[1][0] + log[item[0], BORDER])[1][1]
    letters = []
    while best:
        letter, best = best
        letters.append(letter)
    return "".join(reversed(letters))


def readings(token: str, model: CharModel) -> list[str]:
    """The plain word of a token, and the restored one where it may be disguised."""
    bare = token[:-1] if token[-1:] in _STOPS else token
    if bare.isalpha() and not _STRETCHED.search(simple := plain(bare)):
        return [simple]
    word = plain(token).strip(_EDGES)
    if not word:
        return [restored(token, model)] if any(c in LOOKALIKES for c in token) and any(map(str.isalpha, token)) else []
    disguised = not word.isalpha() and any(map(str.isalpha, word))
    stretched = bool(_STRETCHED.search(word))
    whole = plain(token)
    edged = any(c in LOOKALIKES for c in whole[: len(whole) - len(whole.lstrip(_EDGES))] + whole[len(whole.rstrip(_EDGES)) :])
    found = [word]
    if disguised or stretched or edged and len(word) > 1:
        found.append(restored(whole.strip(".,;:?\"'"), model))
    return [x for x in dict.fromkeys(found) if x]


def tokens(text: str, model: CharModel) -> list[str]:
    """The text's words; three or more spaced-out letters give the words behind them, too."""
    words = text.split()
    if _MAYBE_SPACED.search(text):
        for match in _SPACED.finditer(text):
            words += (word for word in restored(match[0], model).split(GAP) if len(word) > 1)
    return words


def features(word: str) -> list[str]:
    """A word and its beginnings, by which its inflected forms are known."""
    return [f"={word}", *(f"{n}{word[:n]}" for n in (4, 5, 6) if len(word) > n)]


def _signature(text: str) -> int:
    """Equal for most near copies of a text: the smallest hash of its word pairs."""
    words = text.split()
    return min((xxhash.xxh64_intdigest(f"{a} {b}") for a, b in zip(words, words[1:])), default=0) >> 1


def _texts_with(texts: DataFrame, model: CharModel, wanted: frozenset[str] | None) -> DataFrame:
    """(feature, texts): how many texts have each feature, or each of the wanted ones.

    Each task counts its own texts before anything is shuffled.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = Counter()
        for batch in batches:
            for text in batch.column(0):
                words = {w for t in set(tokens(text.as_py() or "", model)) for w in readings(t, model)}
                found = {f for w in words for f in features(w)}
                total.update(found if wanted is None else found & wanted)
        yield pa.RecordBatch.from_pydict(
            {"feature": pa.array(list(total), pa.string()), "texts": pa.array(list(total.values()), pa.int64())}
        )

    return (
        texts.select("text")
        .mapInArrow(count, "feature string, texts bigint")
        .groupBy("feature")
        .agg(F.sum("texts").alias("texts"))
    )


def lexicon(
    sample: DataFrame, model: CharModel, least: int = 4, doubt: float = 2.0
) -> dict[str, float]:
    """The log odds of features that mark label 1, from rows (text, label).

    Texts with the same signature count once, so that copies of one text prove
    nothing. A feature is kept if ``least`` texts of label 1 have it and its
    log odds, less ``doubt`` standard errors, exceed those of the sample by 1.5.
    ``least`` and the sample's bound also bound the lexicon.
    """
    signature = F.pandas_udf(lambda texts: texts.map(lambda x: _signature(x or "")), "bigint")
    single = stored(
        sample.withColumn("signature", signature("text"))
        .groupBy("label", "signature")
        .agg(F.min("text").alias("text"))
    )
    texts = {row["label"]: row["count"] for row in single.groupBy("label").count().collect()}
    marks = _texts_with(single.where("label = 1"), model, None).where(F.col("texts") >= least)
    ones = {row["feature"]: row["texts"] for row in marks.collect()}
    others = _texts_with(single.where("label = 0"), model, frozenset(ones))
    zeros = {row["feature"]: row["texts"] for row in others.collect()}
    prior = math.log((texts.get(1, 0) + 0.5) / (texts.get(0, 0) + 0.5))
    kept = {}
    for feature, count in ones.items():
        with_it, without = count + 0.5, zeros.get(feature, 0) + 0.5
        odds = math.log(with_it / without) - prior
        if odds - doubt * math.sqrt(1 / with_it + 1 / without) > 1.5:
            kept[feature] = odds
    return kept


EVIDENCE = ("strongest", "second", "hits", "hit_share")


@dataclass
class ToxicityModel:
    """Character model, lexicon, and the weights of a text's evidence."""

    characters: CharModel
    words: dict[str, float]
    weights: tuple[float, ...] = (0.0,) * len(EVIDENCE)
    intercept: float = 0.0
    known: dict[str, float] = field(default_factory=dict)

    def __getstate__(self):
        return {**self.__dict__, "known": {}}

    def weight(self, token: str) -> float:
        """The largest log odds of the token's readings; zero if none is in the lexicon."""
        value = self.known.get(token)
        if value is None:
            found = (self.words.get(f, 0.0) for w in readings(token, self.characters) for f in features(w))
            value = max(found, default=0.0)
            if len(token) <= 48:
                if len(self.known) >= 300_000:
                    self.known.clear()
                self.known[token] = value
        return value

    def evidence(self, text: str | None) -> tuple[float, ...]:
        """The two largest weights of the text's words, and number and share of those with any."""
        words = tokens(text or "", self.characters)
        known = self.known.get
        weights = [self.weight(t) if w is None else w for t, w in zip(words, map(known, words))]
        hits = sorted((w for w in weights if w), reverse=True)
        first, second = (hits + [0.0, 0.0])[:2]
        return first, second, math.log1p(len(hits)), len(hits) / max(1, len(words))


def _with_evidence(frame: DataFrame, model: ToxicityModel, text_column: str = "text") -> DataFrame:
    @F.pandas_udf("array<double>")
    def found(texts: pd.Series) -> pd.Series:
        return pd.Series([list(model.evidence(x)) for x in texts])

    return frame.withColumn("evidence", found(text_column))


def train(
    documents: DataFrame, labels: DataFrame, label: str = "toxic", max_labelled: int = MAX_LABELLED
) -> ToxicityModel:
    """Character counts over all documents; lexicon and weights from a bounded labelled sample."""
    sample = labelled_sample(documents, labels, label, max_labelled)
    constant = constant_score(sample)
    if constant is not None:
        return ToxicityModel(CharModel({}), {}, intercept=math.log(constant / (1 - constant)))
    model = ToxicityModel(CharModel(trigram_counts(documents)), {})
    model.words = lexicon(sample, model.characters)
    table = _with_evidence(sample, model).select("label", array_to_vector("evidence").alias("features"))
    fitted = LogisticRegression(labelCol="label", regParam=0.001, maxIter=50).fit(table)
    model.weights = tuple(map(float, np.asarray(fitted.coefficients.toArray())))
    model.intercept = float(fitted.intercept)
    return model


def toxicity_scores(
    documents: DataFrame,
    labels: DataFrame,
    threshold: float = 0.5,
    max_labelled: int = MAX_LABELLED,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document.

    Every word of a text is read as it stands and, where it holds signs, stretched
    or spaced-out letters, as the letters that are likeliest behind it. A null or
    empty text has no evidence and gets the score of a text without any. Null ids
    are never held out; repeated rows get equal scores. Without labels of both
    kinds every score is the smoothed share of label 1. An empty table gives no rows.
    """
    rows = documents.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    model = train(rows, labels, max_labelled=max_labelled)
    terms = [F.col("evidence")[i] * w for i, w in enumerate(model.weights)]
    score = 1 / (1 + F.exp(-sum(terms, F.lit(model.intercept))))
    return (
        _with_evidence(rows, model)
        .select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score.alias("score"))
        .withColumn("predicted", (F.col("score") >= threshold).cast("int"))
    )
