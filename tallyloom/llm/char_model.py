"""A character trigram model of the words of a corpus."""

from __future__ import annotations

import math
import unicodedata
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Letters without accents, and the border of a word. They bound the model: 27 ** 3 counts.
LETTERS = "abcdefghijklmnopqrstuvwxyz"
BORDER = "_"
_FLUSH = 300_000

#: Letters that have no accent to lose, and how they are spelled without them; fixed values.
_SPELLED = str.maketrans(
    {"ß": "ss", "æ": "ae", "œ": "oe", "ø": "o", "đ": "d", "ð": "d", "þ": "th", "ł": "l", "ħ": "h", "ı": "i"}
)


def plain(word: str) -> str:
    """Lower case, in letters without accents; signs stay, and so do other scripts."""
    word = word.lower()
    if word.isascii():
        return word
    bare = "".join(c for c in unicodedata.normalize("NFD", word) if not unicodedata.combining(c))
    return bare if bare.isascii() else bare.translate(_SPELLED)


def _trigrams(words: Counter) -> Counter:
    found = Counter()
    for word, times in words.items():
        word = plain(word.strip(".,;:!?\"'()"))
        if word and word.isascii() and word.isalpha():
            word = BORDER * 2 + word + BORDER
            for i in range(len(word) - 2):
                found[word[i : i + 3]] += times
    return found


def trigram_counts(documents: DataFrame, text_column: str = "text") -> dict[str, int]:
    """Trigram counts of all words of all documents.

    Each task counts its own words and sends one row per trigram, so what reaches
    the driver is bounded by the alphabet, and every document takes part.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, total = Counter(), Counter()
        for batch in batches:
            for text in batch.column(0):
                words.update((text.as_py() or "").split())
                if len(words) > _FLUSH:
                    total.update(_trigrams(words))
                    words = Counter()
        total.update(_trigrams(words))
        yield pa.RecordBatch.from_pydict(
            {"trigram": pa.array(list(total), pa.string()), "times": pa.array(list(total.values()), pa.int64())}
        )

    counted = (
        documents.select(F.col(text_column).alias("text"))
        .mapInArrow(count, "trigram string, times bigint")
        .groupBy("trigram")
        .agg(F.sum("times").alias("times"))
    )
    return {row["trigram"]: row["times"] for row in counted.collect()}


class CharModel:
    """Log probabilities of a letter after the two before it, smoothed."""

    def __init__(self, counts: dict[str, int], smoothing: float = 0.5):
        before = Counter()
        for trigram, times in counts.items():
            before[trigram[:2]] += times
        symbols = LETTERS + BORDER
        self.log = {
            (a + b, c): math.log(
                (counts.get(a + b + c, 0) + smoothing) / (before[a + b] + smoothing * len(symbols))
            )
            for a in symbols
            for b in symbols
            for c in symbols
        }
