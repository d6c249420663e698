"""Token counts by byte-pair merging with a heap and a linked list; no ids are made."""

from __future__ import annotations

from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.tokens import PRETOKEN, Memo, Vocabulary, vocabulary


def merged_count(octets: bytes, words: Vocabulary) -> int:
    """Symbols that are left of the bytes when no adjacent pair can be merged.

    The heap holds rank and place of every pair that can be merged; the lowest
    rank, and of these the leftmost place, goes first. Neighbours are linked, so a
    merge touches two pairs only. Entries of pairs that have changed are skipped.
    """
    count = len(octets)
    if count < 2:
        return count
    symbol = words.symbol
    rank_of, products, size = words.ranks.get, words.products, words.size
    at = [symbol[b] for b in octets]
    heap = []
    for i in range(count - 1):
        rank = rank_of(at[i] * size + at[i + 1])
        if rank is not None:
            heap.append(rank * count + i)
    heapify(heap)
    after = list(range(1, count + 1))
    before = list(range(-1, count - 1))
    merges = 0
    while heap:
        rank, i = divmod(heappop(heap), count)
        j = after[i]
        if at[i] < 0 or j == count or rank_of(at[i] * size + at[j]) != rank:
            continue
        merges += 1
        at[i], at[j] = products[rank], -1
        k = after[i] = after[j]
        if k < count:
            before[k] = i
            rank = rank_of(at[i] * size + at[k])
            if rank is not None:
                heappush(heap, rank * count + i)
        h = before[i]
        if h >= 0:
            rank = rank_of(at[h] * size + at[i])
            if rank is not None:
                heappush(heap, rank * count + h)
    return count - merges


class Counter:
    """Counts the tokens of texts with one vocabulary."""

    def __init__(self, path: str):
        self.words = vocabulary(path)
        self.memo = Memo(lambda parts: [self._part(part) for part in parts])

    def _part(self, part: str) -> int:
        return sum(merged_count(x.encode(), self.words) for x in PRETOKEN.findall(part))

    def count(self, text: str) -> int:
        return sum(
            sum(self.memo.values(section)) if special is None else 1
            for section, special in self.words.sections(text)
        )


_COUNTERS: dict[str, Counter] = {}


def counter(path: str) -> Counter:
    """One counter per worker process and vocabulary, kept between tasks."""
    if path not in _COUNTERS:
        _COUNTERS[path] = Counter(path)
    return _COUNTERS[path]


def token_counts(
    documents: DataFrame,
    path: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    limit: int = 512,
) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every document; one pass, no shuffle.

    Special strings within a text count as one token each. A null text counts as
    empty and has no tokens; null ids and repeated rows pass through. An empty
    table gives no rows. Other columns are not read.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = counter(path)
        for batch in batches:
            ids, texts = batch.columns
            octets, counts = [], []
            for text in texts:
                text = text.as_py() or ""
                octets.append(len(text.encode()))
                counts.append(tokens.count(text))
            over = [n > limit for n in counts]
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(octets, pa.int64()), pa.array(counts, pa.int64()), pa.array(over, pa.bool_())],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    rows = documents.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        count, f"doc_id {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean"
    )
