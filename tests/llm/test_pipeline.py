from __future__ import annotations

from collections import Counter

import pytest
from llm_support import union_find
from test_packing import check
from test_simhash import plain_fingerprint
from test_substring_dedup import brute_force

import corpus_pipeline

FOLDER = "/root/testdata/sf0.001"
DOCUMENTS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What each stage reads and gives."""
    folder = tmp_path_factory.mktemp("stages")
    docs, found = spark.read.parquet(f"{FOLDER}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        path = str(folder / name)
        stage(spark, docs, FOLDER).write.parquet(path)
        found[name] = docs, spark.read.parquet(path)
        docs = found[name][1]
    return found


def texts(frame):
    return {row["doc_id"]: row["text"] for row in frame.select("doc_id", "text").collect()}


def test_all_but_the_last_stage_give_documents(stages):
    for name, (_, after) in list(stages.items())[:-1]:
        assert after.columns == DOCUMENTS, name
    assert [name for name, _ in corpus_pipeline.STAGES] == list(stages)


def test_quality_drops_bad_documents_only(spark, stages):
    before, after = map(texts, stages["quality"])
    assert after.items() <= before.items()
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    good = [d for d in before if labels.get(d) == 1]
    assert sum(d in after for d in good) >= 0.95 * len(good)


def test_exact_dedup(stages):
    before, after = map(texts, stages["exact_dedup"])
    last = {}
    for doc_id in sorted(before):
        last[before[doc_id]] = doc_id
    assert after == {doc_id: text for text, doc_id in last.items()}


def test_near_dedup(stages):
    before, after = map(texts, stages["near_dedup"])
    prints = {d: plain_fingerprint(t) for d, t in before.items()}
    links = [
        (a, b) for a in prints for b in prints
        if a < b and (prints[a] ^ prints[b]).bit_count() <= corpus_pipeline.NEAR_BITS
    ]
    assert set(after) == set(union_find(prints, links).values())
    assert after.items() <= before.items()


def test_substring_dedup(stages):
    before, after = stages["substring_dedup"]
    expected = {d: (t if not v[1] else v[2]) for (d, t), v in brute_force(before, 20).items()}
    assert texts(after) == expected
    assert all(r["n_chars"] == len(r["text"]) for r in after.collect() if r["text"] != texts(before)[r["doc_id"]])


def test_packing(stages, tokenizer):
    before, after = stages["packing"]
    check(after.collect(), list(texts(before).items()), tokenizer, 2048)


def test_run_gives_the_rows_of_the_last_stage(spark, stages):
    columns = ["doc_id", "start", "length", "ids_crc32"]
    found = corpus_pipeline.run(spark, FOLDER).select(columns).collect()
    assert Counter(map(tuple, found)) == Counter(map(tuple, stages["packing"][1].select(columns).collect()))
