from __future__ import annotations

import random
import re

import pytest
import xxhash
from llm_support import ODD_DOCUMENTS, union_find

from tallyloom.llm.simhash import (
    SEGMENTS,
    _components,
    _labels,
    _segments,
    ball,
    fingerprint,
    keep_one_of_group,
    near_pairs,
    simhash_groups,
    stars,
)


def plain_fingerprint(text, width=3):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("text", [text for _, text in ODD_DOCUMENTS] + ["ÀB c", "a b", "A"])
def test_fingerprint(text):
    assert fingerprint(text) & (2**64 - 1) == plain_fingerprint(text)


@pytest.mark.parametrize(("distance", "segments"), [(3, 2), (3, 3), (5, 3), (5, 2), (2, 4)])
def test_all_pairs_within_the_distance_are_found(spark, distance, segments):
    random.seed(distance)
    centres = [random.getrandbits(64) for _ in range(12)]
    prints = {c ^ sum(1 << b for b in random.sample(range(64), random.randrange(7))) for c in centres for _ in range(8)}
    signed = [p - 2**64 if p >> 63 else p for p in prints]
    found = near_pairs(spark.createDataFrame([(p,) for p in signed], "fp bigint"), distance, segments).collect()
    wanted = {
        (a, b) for a in signed for b in signed if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= distance
    }
    assert len(found) == len(wanted) and {tuple(row) for row in found} == wanted


def test_balls_are_enumerated_at_every_size(spark):
    """The plan for a few fingerprints looks up the changed values of both segments."""
    masks = [ball(width, 1) for _, width in _segments(SEGMENTS)]
    assert [len(found) for found in masks] == [33, 33] and masks[0][:3] == [0, 1, 2]
    pairs = near_pairs(spark.range(200).selectExpr("id * 7919 AS fp"))
    plan = pairs._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("explode([0,1,2,4,8,16,32,64") == 2


def test_links_of_a_large_group_are_linear(spark):
    """20,000 near copies: a link a member and segment, and few pairs apart."""
    random.seed(4)
    centre = random.getrandbits(63)
    prints = {centre}
    while len(prints) < 20_000:
        prints.add(centre ^ sum(1 << b for b in random.sample(range(63), random.choice((1, 2, 3, 3, 3)))))
    nodes = spark.createDataFrame([(p, p) for p in prints], "fp bigint, first bigint")
    links = stars(nodes).collect()
    assert len(links) <= 2 * len(prints)
    labelled = _labels(nodes, spark.createDataFrame([(row.a, row.b) for row in links], "a bigint, b bigint"))
    assert near_pairs(labelled.select("fp", "label")).count() <= len(prints)
    assert {row.component_id for row in _components(nodes, 3, SEGMENTS).collect()} == {min(prints)}


def test_groups_of_odd_documents(odd):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    prints = [plain_fingerprint(text) for _, text in rows]
    links = [(i, j) for i in range(len(rows)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 3]
    group = union_find(range(len(rows)), links)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[group[i]] = min(doc_id, least.get(group[i], doc_id))
    expected = sorted(str((d, f"{prints[i]:016x}", least.get(group[i]))) for i, (d, _) in enumerate(rows))
    assert sorted(str(tuple(r)) for r in simhash_groups(odd).collect()) == expected
    kept = keep_one_of_group(odd)
    assert kept.columns == odd.columns
    assert {r["doc_id"] for r in kept.collect()} == {least[g] for g in set(group.values()) if g in least}


def test_rows_that_share_an_id_are_judged_by_their_own_texts(spark):
    a, b, c, d = (" ".join(f"{x}{i}" for i in range(3000)) for x in "abcd")
    rows = [
        (1, a), (None, a + " more"), (None, b), (None, b + " more"), (None, c),  # null ids in three groups
        (5, d), (5, "a text of its own"), (4, d + " more"), (7, None), (None, ""),
    ]
    for one, more in ((a, a + " more"), (b, b + " more"), (d, d + " more")):
        assert (plain_fingerprint(one) ^ plain_fingerprint(more)).bit_count() <= 3
    documents = spark.createDataFrame(rows, "doc_id bigint, text string")
    gone = [(None, a + " more"), (5, d), (None, "")]
    kept = [tuple(row) for row in keep_one_of_group(documents).collect()]
    assert sorted(kept, key=str) == sorted((row for row in rows if row not in gone), key=str)


def test_empty_table(nothing):
    assert simhash_groups(nothing).collect() == []
    assert keep_one_of_group(nothing).collect() == []


@pytest.mark.parametrize("distance", [3, 4, 6])
def test_stars_and_pairs_give_the_same_groups(spark, distance):
    random.seed(12)
    centres = [random.getrandbits(64) for _ in range(9)]
    prints = {c ^ sum(1 << b for b in random.sample(range(64), random.randrange(9))) for c in centres for _ in range(9)}
    signed = sorted(p - 2**64 if p >> 63 else p for p in prints)
    links = [
        (a, b) for a in signed for b in signed if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= distance
    ]
    nodes = spark.createDataFrame([(p, p) for p in signed], "fp bigint, first bigint")
    found = dict(map(tuple, _components(nodes, distance, 2 if distance < 6 else 4).collect()))
    assert found == union_find(signed, links)


def test_dotted_and_clashing_columns_stay(spark):
    rows = [(1, "a b c d", 5, "x"), (2, "a b c d", 6, "y")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, `meta.lang` int, digest0 string")
    assert [tuple(row) for row in keep_one_of_group(frame).collect()] == rows[:1]
