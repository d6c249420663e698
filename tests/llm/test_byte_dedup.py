from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest
from llm_support import ODD_DOCUMENTS
from pyspark.sql import functions as F

from tallyloom.llm.byte_dedup import anchors, without_repeated_bytes
from tallyloom.llm.suffix_family import SuffixFamily


def brute_force(texts, width):
    texts = [(text or "").encode() for text in texts]
    times = Counter(text[i : i + width] for text in texts for i in range(len(text) - width + 1))
    found = []
    for text in texts:
        gone = np.zeros(len(text) + 1, bool)
        for i in range(len(text) - width + 1):
            if times[text[i : i + width]] > 1:
                gone[i : i + width] = True
        spans = int((gone[1:] & ~gone[:-1]).sum() + (gone[0] and len(text) > 0))
        kept = bytes(octet for octet, removed in zip(text, gone) if not removed)
        found.append((len(text), int(gone.sum()), spans, kept))
    return found


def made(seed, count=60):
    random.seed(seed)
    shared = ["".join(random.choice("abcdé ") for _ in range(random.randint(5, 90))) for _ in range(6)]
    texts = []
    for _ in range(count):
        parts = [
            random.choice((random.choice(shared), "".join(random.choice("abcdé ") for _ in range(30)), "z" * 40))
            for _ in range(random.randint(0, 6))
        ]
        texts.append("".join(parts))
    return [*texts, texts[0], texts[1], "q" * 1500, "line one\n" * 20, None, "", "\0" * 60]


@pytest.mark.parametrize("batch", [4, 64, 1 << 17])
def test_family_finds_what_occurs_twice(batch):
    random.seed(batch)
    for width in (3, 5, 8):
        family, places, texts = SuffixFamily(width, batch), [], []
        for _ in range(60):
            texts.append(bytes(random.choice(b"ab\0") for _ in range(random.randint(0, 30))))
            places.append(family.add(texts[-1], len(texts) == 7))
        family.flush()
        times = Counter(text[i : i + width] for text in texts for i in range(len(text) - width + 1))
        for number, (text, place) in enumerate(zip(texts, places)):
            for i in range(len(text) - width + 1):
                assert family.matched[place + i] == (number == 6 or times[text[i : i + width]] > 1)


def test_levels_double_and_hold_each_sequence_once():
    random.seed(1)
    family = SuffixFamily(4, 8)
    text = bytes(random.choice(b"abcdefgh") for _ in range(400))
    for at in range(0, 400, 20):
        family.add(text[at : at + 20])
    family.flush()
    held = [family._sequence(s) for level in family.levels if level is not None for s in level.tolist()]
    assert len(held) == len(set(held))
    assert all(len(level) <= 8 << i for i, level in enumerate(family.levels) if level is not None)
    for level in family.levels:
        if level is not None:
            keys = [family._sequence(s) for s in level.tolist()]
            assert keys == sorted(keys)


def test_equal_sequences_have_equal_anchors():
    random.seed(5)
    data = np.array([random.choice(b"abc") for _ in range(3000)], np.uint8)
    document = np.repeat(np.arange(6), 500)
    found, first, count, places = anchors(data, document, 20, 8)
    of, self_repeats = {}, Counter()
    for hashed, start, length, twice in zip(found, first, count, places):
        windows = [data[s : s + 20].tobytes() for s in range(start, start + length)]
        assert document[start] == document[start + length + 18]
        if len(set(windows)) < len(windows):
            assert twice == 2
        for window in windows:
            assert of.setdefault(window, hashed) == hashed
            self_repeats[window] += 1
    assert sum(count) == 6 * (500 - 19)


@pytest.mark.parametrize("options", [{}, {"common": 0}, {"common": 3, "shard": 500}])
def test_same_as_brute_force(spark, options):
    texts = made(len(options))
    frame = spark.createDataFrame([(i, text) for i, text in enumerate(texts)], "doc_id int, text string")
    marked, names = without_repeated_bytes(frame.repartition(5), 20, anchor=8, **options)
    rows = {row.doc_id: tuple(row)[2:] for row in marked.collect()}
    for number, expected in enumerate(brute_force(texts, 20)):
        assert (*rows[number][:3], bytes(rows[number][3])) == expected, texts[number]


def test_odd_documents_and_clashing_columns(spark, odd, nothing):
    frame = odd.withColumns({name: F.lit("x") for name in ("n_bytes", "several", "meta.lang", "result")})
    marked, names = without_repeated_bytes(frame)
    assert names["n_bytes"] == "n_bytes_" and marked.columns[: len(frame.columns)] == frame.columns
    rows = sorted(
        (repr(row.text), row[names["n_bytes"]], row[names["n_removed"]], row[names["n_spans"]], bytes(row[names["kept"]]))
        for row in marked.collect()
    )
    texts = [text for _, text in ODD_DOCUMENTS]
    assert rows == sorted((repr(text), *found) for text, found in zip(texts, brute_force(texts, 200)))
    assert without_repeated_bytes(nothing)[0].collect() == []
