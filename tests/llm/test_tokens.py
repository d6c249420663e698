from __future__ import annotations

import hashlib
import random
from array import array

import pytest
from llm_support import PATH

from tallyloom.llm.bpe_codec import Codec, digests, encoded
from tallyloom.llm.packing import _ids
from tallyloom.llm.token_count import Counter, token_counts
from tallyloom.llm.tokens import Memo

ALPHABET = [*"aaabcdeetho  \n\t'sSTRE.,!*&%12²½", "\x85", "\xa0", "\x1c", " ", "é", "中", "😀", "̀", "​"]
ALPHABET += ["<|endoftext|>", " \n", "'ll", " the", " and", "ing", "\x00"]


@pytest.fixture(scope="module")
def texts():
    random.seed(9)
    made = ["".join(random.choices(ALPHABET, k=random.randrange(50))) for _ in range(1500)]
    return made + ["a" * 3000, "ab" * 1500, "\n" * 400 + "x", " " * 700, "!" * 600, "abcabcabd" * 200]


def test_counts_ids_and_text_are_those_of_the_library(texts, tokenizer):
    counter, codec = Counter(PATH), Codec(PATH)
    for text in texts:
        ids = tokenizer.encode(text, add_special_tokens=False).ids
        assert counter.count(text) == len(ids)
        assert array("I", codec.encode(text)).tolist() == ids
        assert array("I", _ids(PATH, text)).tolist() == ids
        assert codec.decode(codec.encode(text)) == text


def test_broken_bytes_decode_as_in_the_library(tokenizer):
    codec = Codec(PATH)
    ids = tokenizer.encode("é中😀", add_special_tokens=False).ids
    for cut in (ids[1:], ids[:-1], ids[::-1], [50256, *ids[1:2]]):
        expected = tokenizer.decode(cut, skip_special_tokens=False)
        assert codec.decode(array("I", cut).tobytes()) == expected


def test_forgetting_changes_no_value():
    memo = Memo(lambda parts: [len(p) for p in parts], limit=2, longest=3)
    for text in ("aa bb cc dd", "dd, cc. bb aa", "a  b\n c", "", " x "):
        assert sum(memo.values(text)) == len(text)


def test_rows_of_odd_documents(odd, tokenizer):
    rows = odd.select("doc_id", "text").collect()
    ids = [tokenizer.encode(r["text"] or "", add_special_tokens=False).ids for r in rows]
    counted = [
        (r["doc_id"], len((r["text"] or "").encode()), len(i), len(i) > 512) for r, i in zip(rows, ids)
    ]
    assert sorted(map(str, map(tuple, token_counts(odd, PATH).collect()))) == sorted(map(str, counted))
    little = [b"".join(x.to_bytes(4, "little") for x in i) for i in ids]
    digested = [
        (r["doc_id"], len(i), hashlib.sha256(b).hexdigest(), hashlib.sha256((r["text"] or "").encode()).hexdigest())
        for r, i, b in zip(rows, ids, little)
    ]
    assert sorted(map(str, map(tuple, digests(odd, PATH).collect()))) == sorted(map(str, digested))
    back = encoded(odd, PATH).collect()
    assert sorted(r["decoded"] for r in back) == sorted(r["text"] or "" for r in rows)
    assert sorted(bytes(r["ids"]) for r in back) == sorted(little)


def test_empty_table(nothing):
    assert token_counts(nothing, PATH).collect() == []
    assert digests(nothing, PATH).collect() == []
