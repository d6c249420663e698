from __future__ import annotations

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from tallyloom.llm import conversation_trie as module
from tallyloom.llm.conversation_trie import conversation_trie

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def brute_force(rows):
    original = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            original.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    original = {conv: [turn[2:] for turn in sorted(turns)] for conv, turns in original.items()}
    rebuilt = {}
    for conv, turns in original.items():
        h = zlib.crc32(str(conv).encode()) % 9
        rebuilt[conv] = original.get(conv - conv % 5, [])[:h] + turns[h:]
    members = {}
    for conv, turns in rebuilt.items():
        for depth in range(len(turns) + 1):
            members.setdefault(tuple(turns[:depth]), []).append(conv)
    children, leaves, saved = {}, {}, {}
    for node in members:
        if node:
            children[node[:-1]] = children.get(node[:-1], 0) + 1
    for node, convs in members.items():
        for depth in range(len(node) + 1):
            above = node[:depth]
            leaves[above] = leaves.get(above, 0) + (node not in children)
            own = (len(convs) - 1) * len(node[-1][1].encode()) if node else 0
            saved[above] = saved.get(above, 0) + own
    found = []
    for node, convs in members.items():
        ends = ",".join(str(conv) for conv in sorted(convs) if len(rebuilt[conv]) == len(node))
        parent = min(members[node[:-1]]) if node else None
        digest = hashlib.sha256(ends.encode()).hexdigest()
        found.append(
            (min(convs), len(node), parent, len(convs), children.get(node, 0), leaves[node], saved[node], digest)
        )
    return sorted(found, key=repr)


def rows_of(frame):
    return sorted((tuple(row) for row in frame.collect()), key=repr)


def made(seed, convs=40, longest=12):
    random.seed(seed)
    rows = []
    for conv in random.sample(range(200), convs):
        for turn in range(random.randint(1, longest)):
            text = random.choice(("a", "bé", "", None))
            rows.append((conv, random.choice((turn, turn, turn, None, 0)), random.choice(("u", "u", "v", None)), text))
    random.shuffle(rows)
    return rows


@pytest.mark.parametrize("band", [2, 3, 8])
def test_same_as_brute_force(spark, band):
    rows = made(band) + [(conv, turn, "u", "a") for conv in (3, 5, 11) for turn in range(25)]
    found = conversation_trie(spark.createDataFrame(rows, SCHEMA).repartition(4), band=band)
    assert rows_of(found) == brute_force(rows)


def test_long_conversations_are_counted_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(module, "BLOCK", 4)
    rows = made(9, longest=30)
    assert rows_of(conversation_trie(spark.createDataFrame(rows, SCHEMA))) == brute_force(rows)


def test_many_conversations_may_end_at_one_node(spark, monkeypatch):
    monkeypatch.setattr(module, "IDS", 7)
    rows = [(conv, turn, "u", "same") for conv in range(90) for turn in range(3)]
    assert rows_of(conversation_trie(spark.createDataFrame(rows, SCHEMA))) == brute_force(rows)


def test_nulls_negative_ids_and_turnless_conversations(spark):
    rows = [
        (None, 0, "u", "left out"),
        (7, 0, "u", "x"),
        (8, None, None, None),
        (8, None, None, None),
        (5, 1, "u", "x" * 5000),
        (5, 0, "user:1:", "y"),
    ]
    frame = spark.createDataFrame(rows, SCHEMA).withColumns({n: F.lit(1) for n in ("depth", "k1", "meta.x")})
    assert rows_of(conversation_trie(frame)) == brute_force(rows)
    negative = conversation_trie(spark.createDataFrame([(-7, 0, "u", "x")], SCHEMA)).collect()
    assert {row.conv_id for row in negative} == {-7}


def test_no_conversations_have_no_nodes(spark):
    empty = conversation_trie(spark.createDataFrame([], SCHEMA))
    assert empty.collect() == []
    assert conversation_trie(spark.createDataFrame([(None, 1, "u", "x")], SCHEMA)).collect() == []
