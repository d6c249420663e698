from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.llm.fm_index import FMIndex
from tallyloom.llm.substring_dedup import anchors, removals, remove_repeats, without_repeats


def test_windows_match_exactly_those_with_equal_words():
    random.seed(2)
    sequences = [np.array([random.randint(1, 3) for _ in range(random.randint(0, 40))]) for _ in range(30)]
    sequences.append(np.full(70, 2))
    index = FMIndex(sequences)
    starts, words = [], []
    for begin, sequence in zip(index.starts, sequences):
        for i in range(len(sequence) - 5):
            starts.append(begin + i)
            words.append(tuple(sequence[i : i + 6]))
    found = index.matches(np.array(starts), 6)
    rows = {}
    for word, row in zip(words, found):
        assert (words.count(word) > 1) == (row >= 0)
        assert rows.setdefault(word, row) == row
    several = [row for row in rows.values() if row >= 0]
    assert len(several) == len(set(several))


def test_matching_statistics_are_those_of_brute_force():
    random.seed(3)
    sequences = [np.array([random.randint(1, 4) for _ in range(random.randint(0, 30))]) for _ in range(25)]
    sequences.append(np.full(40, 3))
    index = FMIndex(sequences)
    ends, most, longest = [], [], []
    held = [tuple(sequence) for sequence in sequences]

    def times(words):
        return sum(s[i : i + len(words)] == words for s in held for i in range(len(s) - len(words) + 1))

    for begin, sequence in zip(index.starts, held):
        for i in range(len(sequence)):
            ends.append(begin + i)
            most.append(min(12, i + 1))
            longest.append(max((n for n in range(1, most[-1] + 1) if times(sequence[i + 1 - n : i + 1]) > 1), default=0))
    lengths, rows = index.matching_statistics(np.array(ends), np.array(most))
    assert lengths.tolist() == longest
    assert ((rows >= 0) == (lengths > 0)).all()


@pytest.fixture(scope="module")
def passages(spark):
    random.seed(5)
    vocabulary = [f"w{i}" for i in range(60)]
    shared = [random.choices(vocabulary, k=random.randint(10, 45)) for _ in range(6)]
    rows = []
    for doc_id in range(50):
        words = []
        for _ in range(random.randint(0, 6)):
            kind = random.random()
            if kind < 0.5:
                words += random.choice(shared)
            elif kind < 0.7:
                words += [random.choice(vocabulary[:3])] * random.randint(1, 60)
            else:
                words += random.choices(vocabulary, k=random.randint(1, 40))
        rows.append((doc_id, random.choice([" ", "\n", "  "]).join(words)))
    rows += [(None, rows[3][1]), (200, None), (201, ""), (3, rows[3][1]), (3, rows[5][1])]
    return spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("kept", F.lit(1))


def brute_force(frame, window):
    keyed = frame.select("doc_id", "text", F.xxhash64("doc_id", "text")).distinct().collect()
    keyed.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[2]))
    seen, result = set(), {}
    for doc_id, text, _ in keyed:
        words = (text or "").split()
        gone = [False] * len(words)
        for i in range(len(words) - window + 1):
            body = tuple(words[i : i + window])
            if body in seen:
                gone[i : i + window] = [True] * window
            seen.add(body)
        left = " ".join(w for w, g in zip(words, gone) if not g)
        result[doc_id, text] = (len(words), sum(gone), left)
    return result


@pytest.mark.parametrize(
    ("window", "options"), [(20, {}), (20, {"common": 2, "shard": 50}), (12, {"anchor": 6, "common": 3})]
)
def test_repeated_words_of_passages(passages, window, options):
    expected = brute_force(passages, window)
    marked, names = without_repeats(passages, window, **options)
    rows = marked.collect()
    assert names["kept"] != "kept" and len(rows) == passages.count()
    for row in rows:
        found = tuple(row[names[n]] for n in ("n_words", "n_removed", "kept"))
        assert found == expected[row["doc_id"], row["text"]]


@pytest.mark.parametrize("options", [{}, {"common": 0}])
def test_passages_that_repeat_only_themselves(spark, options):
    rows = [(period, " ".join(f"p{period}w{i % period}" for i in range(60))) for period in range(1, 16)]
    rows += [(100, " ".join(["alone"] * 30)), (101, " ".join(f"x{i}" for i in range(60)))]
    rows += [(102, "before " + " ".join(["long"] * 2500) + " after")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    expected = brute_force(frame, 20)
    assert expected[100, rows[15][1]][1] == 29 and expected[10, rows[9][1]][1] == 50
    marked, names = without_repeats(frame, **options)
    for row in marked.collect():
        assert tuple(row[names[n]] for n in ("n_words", "n_removed", "kept")) == expected[row["doc_id"], row["text"]]


def test_places_of_an_anchor_are_counted_within_its_run():
    random.seed(8)
    for words in [random.choices([b"a", b"b", b"c"], k=random.randint(20, 90)) for _ in range(60)] + [[b"a"] * 25]:
        grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
        for _, first, windows, places in zip(*anchors(words, 20, 3)):
            inside = grams[first : first + windows + 17]
            shared = [set(grams[at : at + 18]) for at in range(first, first + windows)]
            assert any(inside.count(gram) == places for gram in set.intersection(*shared))


def test_clean_texts_stay_as_they_are(passages, odd):
    expected = brute_force(odd, 20)
    for row in remove_repeats(odd).collect():
        changed = [v for (d, t), v in expected.items() if d == row["doc_id"]]
        texts = {t if v[1] == 0 else v[2] for (d, t), v in expected.items() if d == row["doc_id"]}
        assert changed and row["text"] in texts
    assert remove_repeats(odd).columns == odd.columns


def test_rows_that_repeat_are_one_document(spark):
    """Segments, and with them the work, do not grow with the square of equal rows."""
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(None, text)] * 300 + [(None, text + " more")] * 2 + [(1, text)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    expected = brute_force(frame, 20)
    found = removals(frame)
    assert sum(len(row.spans) for row in found.collect()) <= 400
    marked, names = without_repeats(frame)
    for row in marked.collect():
        assert tuple(row[names[n]] for n in ("n_words", "n_removed", "kept")) == expected[row["doc_id"], row["text"]]


def test_dotted_columns_stay(spark):
    frame = spark.createDataFrame([(1, "a b", 3)], "doc_id bigint, text string, `meta.lang` int")
    assert remove_repeats(frame).collect() == frame.collect()


def test_empty_table(nothing):
    assert without_repeats(nothing)[0].collect() == []
