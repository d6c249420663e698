"""Byte-pair encoding by dynamic programming over prefixes, and decoding."""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.token_count import merged_count
from tallyloom.llm.tokens import PRETOKEN, Memo, vocabulary

_NEVER = 1 << 62


class Codec:
    """Encodes and decodes texts with one vocabulary."""

    def __init__(self, path: str):
        self.words = words = vocabulary(path)
        self.length = {i: len(octets) for i, octets in words.octets.items()}
        self.suffixes = ahocorasick.Automaton()
        for i, octets in words.octets.items():
            self.suffixes.add_word(octets.decode("latin-1"), i)
        self.suffixes.make_automaton()
        self.pairs: dict[int, bool] = {}
        self.alone: dict[int, bool] = {}
        self.memo = Memo(lambda parts: [self._part(part) for part in parts])
        known = words.octets | {i: text.encode() for text, i in words.special.items()}
        self.octets = [known.get(i, b"") for i in range(words.size)]

    def _stands_alone(self, token: int) -> bool:
        """Whether the token's own bytes are merged to that one token."""
        found = self.alone.get(token)
        if found is None:
            found = self.alone[token] = merged_count(self.words.octets[token], self.words) == 1
        return found

    def _compatible(self, left: int, right: int) -> bool:
        """Whether the two tokens stay apart when their bytes are merged together.

        Undoes the merges on both sides of the border, latest first. They stay
        apart unless some pair that meets at the border has a rank so low that it
        goes before its left part is used up, or no later than its right part is;
        of equal ranks the leftmost pair goes first.
        """
        key = left * self.words.size + right
        known = self.pairs.get(key)
        if known is not None:
            return known
        rank_of, size, made_by = self.words.ranks.get, self.words.size, self.words.made_by
        x, y, x_used, y_used, apart = left, right, _NEVER, _NEVER, True
        while True:
            rank = rank_of(x * size + y)
            if rank is not None and rank < x_used and rank <= y_used:
                apart = False
                break
            x_made, y_made = made_by.get(x), made_by.get(y)
            if x_made is None and y_made is None:
                break
            if y_made is None or x_made is not None and x_made[0] > y_made[0]:
                x_used, _, x = x_made
            else:
                y_used, y, _ = y_made
        if len(self.pairs) >= 1_000_000:
            self.pairs.clear()
        self.pairs[key] = apart
        return apart

    def _pretoken(self, octets: bytes) -> list[int]:
        """The ids, from the one last token that each prefix can have."""
        count, length = len(octets), self.length
        last = [-1] * (count + 1)
        for end, token in self.suffixes.iter(octets.decode("latin-1")):
            end += 1
            if last[end] >= 0:
                continue
            start = end - length[token]
            if start == 0:
                if self._stands_alone(token):
                    last[end] = token
            elif last[start] >= 0 and self._compatible(last[start], token):
                last[end] = token
        ids, end = [], count
        while end:
            ids.append(last[end])
            end -= length[last[end]]
        ids.reverse()
        return ids

    def _part(self, part: str) -> bytes:
        ids = array("I")
        for pretoken in PRETOKEN.findall(part):
            ids.extend(self._pretoken(pretoken.encode()))
        return ids.tobytes()

    def encode(self, text: str) -> bytes:
        """The ids as 32-bit integers of the machine's byte order."""
        return b"".join(
            b"".join(self.memo.values(section)) if special is None else array("I", [special]).tobytes()
            for section, special in self.words.sections(text)
        )

    def decode(self, ids: bytes) -> str:
        """The text of the ids; bytes that are no UTF-8 become replacement characters."""
        return b"".join(map(self.octets.__getitem__, memoryview(ids).cast("I"))).decode("utf-8", "replace")


_CODECS: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    """One codec per worker process and vocabulary, kept between tasks."""
    if path not in _CODECS:
        _CODECS[path] = Codec(path)
    return _CODECS[path]


def little_endian(ids: bytes) -> bytes:
    values = array("I", ids)
    if array("H", [1]).tobytes() != b"\x01\x00":
        values.byteswap()
    return values.tobytes()


def encoded(
    documents: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """(doc_id, ids, decoded): ids as little-endian unsigned 32-bit integers, and their text.

    Special strings within a text become their ids. A null text counts as empty.
    Null ids and repeated rows pass through; an empty table gives no rows. Other
    columns are not read.
    """
    return _mapped(
        documents, path, id_column, text_column, "ids binary, decoded string", lambda ids, text: (ids, text)
    )


def digests(
    documents: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256); rows as those of ``encoded``.

    Digests are taken where the ids are made, so that ids and texts never leave the task.
    """
    return _mapped(
        documents,
        path,
        id_column,
        text_column,
        "n_tokens bigint, ids_sha256 string, decoded_sha256 string",
        lambda ids, text: (
            len(ids) // 4,
            hashlib.sha256(ids).hexdigest(),
            hashlib.sha256(text.encode()).hexdigest(),
        ),
    )


def _mapped(documents, path, id_column, text_column, columns, made) -> DataFrame:
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = codec(path)
        for batch in batches:
            names, texts = batch.columns
            for at in range(0, len(texts), 500):
                rows = []
                for text in texts.slice(at, 500):
                    ids = tokens.encode(text.as_py() or "")
                    rows.append(made(little_endian(ids), tokens.decode(ids)))
                columns_made = [pa.array(column) for column in zip(*rows)]
                yield pa.RecordBatch.from_arrays([names.slice(at, 500), *columns_made], names=fields)

    rows = documents.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    fields = ["doc_id", *(column.split()[0] for column in columns.split(", "))]
    return rows.mapInArrow(encode, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, {columns}")
