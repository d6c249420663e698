from __future__ import annotations

import itertools
import math
import random
import zlib

import pytest
from pyspark.sql import functions as F

from tallyloom.llm.char_model import BORDER, CharModel, plain, trigram_counts
from tallyloom.llm.learning import labelled_sample
from tallyloom.llm.quality import STATISTICS, Rule, keep_good, quality_scores, scored, statistics, train, tree_rules
from tallyloom.llm.queries import op6_quality, op10_toxicity
from tallyloom.llm.toxicity import GAP, lattice, restored, tokens, toxicity_scores

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{FOLDER}/labels.parquet")


def held_out_accuracy(spark, frame, labels, label):
    """Share of right predictions, over documents kept from training, and its baseline."""
    rows = frame.join(labels, "doc_id").collect()
    for row in rows:
        assert row["held_out"] == (zlib.crc32(str(row["doc_id"]).encode()) % 5 == 0)
        assert 0 <= row["score"] <= 1
    apart = [row for row in rows if row["held_out"]]
    ones = sum(row[label] for row in apart)
    right = sum(row["predicted"] == row[label] for row in apart)
    return right / len(apart), max(ones, len(apart) - ones) / len(apart)


def test_quality_of_held_out_documents(spark, labels):
    found = op6_quality(spark, FOLDER)
    assert found.count() == 1000
    accuracy, baseline = held_out_accuracy(spark, found, labels, "quality")
    assert accuracy > 0.95 > baseline


def test_toxicity_of_held_out_documents(spark, labels):
    found = op10_toxicity(spark, FOLDER)
    assert found.count() == 1000
    accuracy, baseline = held_out_accuracy(spark, found, labels, "toxic")
    assert accuracy > 0.93 and accuracy > baseline


def test_rules_are_the_paths_of_the_trees():
    printed = """Model (numTrees=1)
  Tree 0 (weight 1.0):
    If (feature 0 <= 2.5)
     If (feature 0 <= 1.5)
      Predict: 0.0
     Else (feature 0 > 1.5)
      Predict: 1.0
    Else (feature 0 > 2.5)
     Predict: 1.0
"""
    assert tree_rules(printed, ("a",)) == [
        Rule((("a", False, 2.5),)), Rule((("a", False, 1.5),)),
        Rule((("a", False, 2.5), ("a", True, 1.5))), Rule((("a", True, 2.5),)),
    ]


def test_statistics_of_odd_texts():
    for text in (None, "", " \n\t", "a", "\n\n", "é" * 100_000, "x " * 50_000):
        found = statistics(text)
        assert len(found) == len(STATISTICS) and all(0 <= x < 1e6 for x in found)


@pytest.mark.parametrize("scores", [quality_scores, toxicity_scores])
@pytest.mark.parametrize("kept", [[], [(1, 1, 1), (2, 1, 1), (None, 0, 0), (6, None, None)]])
def test_odd_documents_without_labels_of_both_kinds(spark, odd, nothing, scores, kept):
    few = spark.createDataFrame(kept, "doc_id bigint, quality int, toxic int")
    rows = scores(odd, few).collect()
    assert len(rows) == odd.count() and len({row["score"] for row in rows}) == 1
    assert scores(nothing, few).collect() == []


@pytest.mark.parametrize("scores", [quality_scores, toxicity_scores])
def test_odd_documents_with_labels(spark, odd, labels, scores):
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet").withColumns(
        {name: F.lit(name) for name in odd.columns if name not in ("doc_id", "text")}
    )
    rows = scores(documents.unionByName(odd, allowMissingColumns=True), labels).collect()
    assert len(rows) == 1011 and all(row["score"] is not None for row in rows)


def test_good_documents_stay_unchanged(spark, labels):
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet")
    kept = keep_good(documents, labels)
    assert kept.columns == documents.columns
    joined = kept.join(labels, "doc_id")
    good = labels.where("quality = 1").count()
    assert joined.where("quality = 1").count() >= 0.98 * good
    assert joined.where("quality = 0").count() <= 0.15 * labels.where("quality = 0").count()
    assert kept.exceptAll(documents).isEmpty()


def test_sample_is_bounded_and_holds_no_held_out_document(spark, labels):
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet")
    sample = labelled_sample(documents, labels, "quality", max_labelled=50).collect()
    assert 20 <= len(sample) <= 90
    texts = {row["text"] for row in sample}
    apart = documents.where(F.crc32(F.col("doc_id").cast("string")) % 5 == 0)
    unique = {row["text"] for row in apart.collect()} - {
        row["text"] for row in documents.where(F.crc32(F.col("doc_id").cast("string")) % 5 != 0).collect()
    }
    assert not texts & unique


def test_characters_are_counted_over_all_words(spark, odd, nothing):
    counts = trigram_counts(odd)
    assert counts["__t"] == 14 and counts["ord"] == 3000 and counts["__w"] == 3000
    assert trigram_counts(nothing) == {}


def test_disguised_words_are_restored(spark):
    words = "stupid idiot moron nothing harmless sentence letters morning"
    texts = spark.createDataFrame([(words,)] * 20, "text string")
    model = CharModel(trigram_counts(texts))
    for disguised, plain in [
        ("$tup1d", "stupid"), ("1d10t", "idiot"), ("m0r0n", "moron"), ("s.t-u_p*i.d", "stupid"),
        ("stuuuupid", "stupid"), ("!d!ot", "idiot"), ("harmless", "harmless"), ("l3tt3r5", "letters"),
    ]:
        assert restored(disguised, model) == plain
    assert tokens("so s t u p i d it is", model)[-1] == "stupid"
    assert restored("", model) == "" and restored("123", model) != "123"


def spaced_model(spark):
    words = "a bad idiot stupid here is so nothing harmless sentence " * 3 + "of the and a a a"
    return CharModel(trigram_counts(spark.createDataFrame([(words,)] * 20, "text string")))


def test_spaced_letters_are_joined_and_cut_into_words(spark):
    model = spaced_model(spark)
    for text, words in [
        ("a i d i o t here", ["idiot"]), ("s  t  u  p  i  d", ["stupid"]), ("b\ta\td", ["bad"]), ("b a d", ["bad"]),
        ("so s\nt  u p 1 d", ["stupid"]), ("b a d i d i o t", ["bad", "idiot"]), ("x y", []), ("a b", []),
    ]:
        assert tokens(text, model)[len(text.split()) :] == words, text


def test_decoding_is_exhaustive(spark):
    """The decoded letters are the best of all paths of the lattice, enumerated."""
    model = spaced_model(spark)
    random.seed(6)
    drawn = ["".join(random.choice("aid10t s..b@") for _ in range(random.randint(1, 7))) for _ in range(120)]
    for word in ["b a d", "s t u", "a i d", "1d10t", "baaad", "i  d\ti", *drawn]:
        best = -math.inf
        for path in itertools.product(*lattice(word)):
            total, state = sum(cost for _, cost in path), BORDER * 2
            for letter in "".join(text for text, _ in path):
                if letter == GAP:
                    total, state = total + model.log[state, BORDER], BORDER * 2
                else:
                    total, state = total + model.log[state, letter], state[1] + letter
            total += model.log[state, BORDER]
            if total > best + 1e-9:
                best, letters = total, "".join(text for text, _ in path)
        assert restored(word, model) == letters, word


def test_letters_without_accents_to_lose_are_spelled(spark):
    assert [plain(word) for word in ("Straße", "Øre", "ŁÓDŹ", "Éa", "дом")] == ["strasse", "ore", "lodz", "ea", "дом"]
    assert trigram_counts(spark.createDataFrame([("weiß ßx",)], "text string"))["iss"] == 1


def test_scores_are_those_of_the_rules(spark, labels):
    """Each kept rule evaluated in Python on each text gives the scores of the column expression."""
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet")
    model = train(documents, labels)
    assert model.rules
    marked, names = scored(documents.limit(200), model)
    for row in marked.collect():
        found = dict(zip(STATISTICS, statistics(row["text"])))
        total = model.intercept
        for rule, weight in model.rules:
            if all(found[n] > value if above else found[n] <= value for n, above, value in rule.tests):
                total += weight
        assert row[names["score"]] == pytest.approx(1 / (1 + math.exp(-total)), abs=1e-12)


def test_a_repeated_document_is_learned_from_once(spark, labels):
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet")
    once = labelled_sample(documents, labels, "quality")
    often = labelled_sample(documents.unionAll(documents), labels.unionAll(labels), "quality")
    assert once.count() == often.count() and once.exceptAll(often).isEmpty()


def test_dotted_columns_of_good_documents_stay(spark, labels):
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet").withColumn("meta.lang", F.col("lang"))
    assert keep_good(documents, labels).columns == documents.columns
