from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from tallyloom.llm.exact_dedup import exact_duplicates, keep_one
from llm_support import plan_of


def expected(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[text or ""].append(doc_id)
    result = Counter()
    for doc_id, text in rows:
        ids = groups[text or ""]
        keep = max((i for i in ids if i is not None), default=None)
        digest = hashlib.sha256((text or "").encode()).hexdigest()
        result[doc_id, keep, len(ids), doc_id == keep, digest] += 1
    return result


def pairs(frame):
    return [(row["doc_id"], row["text"]) for row in frame.select("doc_id", "text").collect()]


def test_groups_of_odd_documents(odd):
    assert Counter(map(tuple, exact_duplicates(odd).collect())) == expected(pairs(odd))


def test_colliding_digests_are_told_apart_by_content(odd):
    def weak(text):
        return F.substring(F.sha2(text.cast("binary"), 256), 1, 1)

    assert Counter(map(tuple, exact_duplicates(odd, digest=weak).collect())) == expected(pairs(odd))
    assert sorted(map(str, pairs(keep_one(odd, digest=weak)))) == sorted(map(str, pairs(keep_one(odd))))


def test_one_document_of_each_text_stays_with_its_columns(odd):
    kept = keep_one(odd)
    assert kept.columns == odd.columns
    assert Counter(text or "" for _, text in pairs(kept)) == Counter({t or "": 1 for _, t in pairs(odd)})
    assert (2, "The the cat sat on the mat") in pairs(kept)


def test_the_survivor_is_told_by_its_columns(spark):
    rows = [(2, None, "b"), (2, "", "a"), (2, "", "c"), (1, "x", None), (1, "x", "z")]
    frame = spark.createDataFrame(rows, "doc_id int, text string, `meta.lang` string")
    for parts in (1, 5):
        kept = keep_one(frame.repartition(parts))
        assert kept.columns == frame.columns
        assert sorted(map(tuple, kept.collect())) == [(1, "x", "z"), (2, "", "a")]


def test_empty_table(nothing):
    assert exact_duplicates(nothing).collect() == []
    assert keep_one(nothing).collect() == []


def test_no_python_on_the_way(odd):
    assert "Python" not in plan_of(exact_duplicates(odd)) and "Arrow" not in plan_of(exact_duplicates(odd))
