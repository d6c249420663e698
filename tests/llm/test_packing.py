from __future__ import annotations

import random
import zlib
from collections import defaultdict

from llm_support import PATH
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyloom.llm.packing import pack_histogram, packed


@given(st.dictionaries(st.integers(1, 32), st.integers(1, 60)))
@settings(max_examples=150, deadline=None)
def test_patterns_hold_every_length_and_no_pack_overflows(histogram):
    held = defaultdict(int)
    patterns = pack_histogram(histogram, 32)
    for pattern, packs in patterns:
        assert packs > 0 and sum(length * times for length, times in pattern) <= 32
        for length, times in pattern:
            held[length] += packs * times
    assert held == histogram
    assert len(patterns) <= 2 * 32 + 2


def test_little_padding():
    random.seed(1)
    histogram = defaultdict(int)
    for _ in range(50_000):
        histogram[min(2048, int(random.lognormvariate(6, 1)) + 1)] += 1
    packs = sum(count for _, count in pack_histogram(histogram, 2048))
    assert packs * 2048 <= 1.001 * sum(length * count for length, count in histogram.items()) + 2048


def check(rows, documents, tokenizer, capacity):
    """Each id lies in one piece, pieces have the right ids, and sequences have no gaps or overlaps."""
    ids = defaultdict(list)
    for doc_id, text in documents:
        ids[doc_id].append(tokenizer.encode(text or "", add_special_tokens=False).ids + [1])
    wanted = []
    for doc_id, several in ids.items():
        for one in several:
            for start in range(0, len(one), capacity):
                part = one[start : start + capacity]
                crc = zlib.crc32(b"".join(x.to_bytes(4, "little") for x in part))
                wanted.append((doc_id, start, len(part), crc, len(one)))
    assert sorted(map(str, (tuple(r)[:5] for r in rows))) == sorted(map(str, wanted))
    sequences = defaultdict(list)
    for row in rows:
        sequences[row["sequence_id"]].append((row["offset"], row["length"]))
    for pieces in sequences.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
        assert end <= capacity
    return len(sequences)


def test_odd_documents(odd, tokenizer):
    documents = [(r["doc_id"], r["text"]) for r in odd.collect()]
    for capacity, together in ((2048, 100_000), (16, 3)):
        rows = packed(odd, PATH, capacity=capacity, ranked_together=together).collect()
        count = check(rows, documents, tokenizer, capacity)
        total = sum(r["length"] for r in rows)
        assert (count - 1) * capacity < total + capacity * 2
    assert "ids" in packed(odd, PATH, with_ids=True).columns


def test_empty_table(nothing):
    assert packed(nothing, PATH).collect() == []
