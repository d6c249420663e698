"""Collocations, counted inside the distinct chunks of a prefix-free parse."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.storage import stored, written

#: One in so many sequences of ``max_words - 1`` tokens triggers a cut.
MODULUS = 48
#: Tokens after which a stretch without triggers is cut.
LONGEST = 1024
#: Tokens whose chunks, or whose phrases, a task combines at a time; below 2 ** 31.
BLOCK = 2_000_000
#: Bits of the filter of frequent phrases, a power of two; 8 MB.
FILTER_BITS = 1 << 26
#: Parts in which a language's phrases are ranked before the best of each meet.
SALTS = 16

_SIGNS = b",;:!?\n\x0b\x0c\r"
_UPPER = bytes(range(ord("A"), ord("Z") + 1))
#: Upper case to lower case, the signs between pieces to a full stop, tabs to blanks.
_PLAIN = bytes.maketrans(_UPPER + _SIGNS + b"\t", _UPPER.lower() + b"." * len(_SIGNS) + b" ")
_STOP = b"."


def tokens_of(text: str | None) -> list[bytes]:
    """Words in lower case, with a full stop wherever a piece ends."""
    return (text or "").encode().translate(_PLAIN).replace(b".", b" . ").split()


class _Hashes(dict):
    """Hashes of words, forgotten when there are very many."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 1_000_000:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


class _Numbers(dict):
    """Numbers of words in the order in which they come."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = len(self)
        return value


def _mixed(hashed: np.ndarray) -> np.ndarray:
    hashed = (hashed ^ (hashed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return hashed ^ (hashed >> np.uint64(32))


def _sequence_hashes(hashed: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """A hash of the ``size`` words from each place on, from the hashes of the words."""
    values = hashed[at]
    for i in range(1, size):
        values = values * np.uint64(0x9E3779B97F4A7C15) + hashed[at + i]
    return _mixed(values)


def chunks(
    texts: list[list[bytes]], hashes: dict, overlap: int, modulus: int = MODULUS, longest: int = LONGEST
) -> list[tuple[bytes, int]]:
    """(chunk, own) of the tokens of texts: a chunk's tokens, and how many are its own.

    A chunk runs from one trigger to the next and takes the trigger's ``overlap`` tokens
    along, so every phrase of up to ``overlap + 1`` words lies wholly in the chunk where
    it starts. The tokens taken along are the next chunk's own. Whether tokens are a
    trigger depends on them alone: equal passages give equal chunks.
    """
    tokens = list(chain.from_iterable(texts))
    if not tokens:
        return []
    total, sizes = len(tokens), np.array(list(map(len, texts)))
    end = np.repeat(np.cumsum(sizes), sizes)
    begins = np.zeros(total + 1, bool)
    begins[np.cumsum(sizes)] = True
    begins[0] = True
    if overlap and total >= overlap:
        hashed = np.fromiter(map(hashes.__getitem__, tokens), np.uint64, total)
        at = np.arange(total - overlap + 1)
        trigger = _sequence_hashes(hashed, at, overlap) % np.uint64(modulus) == 0
        begins[at[trigger & (at + overlap <= end[at])]] = True
    elif not overlap:
        begins[::modulus] = True
    first = np.flatnonzero(begins[:total])
    length = np.diff(np.append(first, total))
    times = -(-length // longest)
    step = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
    first = np.repeat(first, times) + step * longest
    own = np.diff(np.append(first, total))
    last = np.minimum(first + own + overlap, end[first])
    return [(b" ".join(tokens[a:b]), n) for a, b, n in zip(first.tolist(), last.tolist(), own.tolist())]


def _dictionary(rows: DataFrame, overlap: int, modulus: int, longest: int) -> DataFrame:
    """(lang, chunk, own, times) of the different chunks of rows (lang, text)."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, waiting, size = _Hashes(), {}, 0
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                tokens = tokens_of(text.as_py())
                waiting.setdefault(lang, []).append(tokens)
                size += len(tokens)
                if size > BLOCK:
                    yield counted(waiting, hashes)
                    waiting, size = {}, 0
        if size:
            yield counted(waiting, hashes)

    def counted(waiting: dict, hashes: dict) -> pa.RecordBatch:
        langs, bodies, owns, times = [], [], [], []
        for lang, texts in waiting.items():
            found = Counter(chunks(texts, hashes, overlap, modulus, longest))
            langs += [lang] * len(found)
            bodies += [body for body, _ in found]
            owns += [own for _, own in found]
            times += found.values()
        return pa.RecordBatch.from_arrays(
            [pa.array(langs, pa.string()), pa.array(bodies, pa.binary()).cast(pa.string())]
            + [pa.array(column, pa.int64()) for column in (owns, times)],
            names=["lang", "chunk", "own", "times"],
        )

    parsed = rows.mapInArrow(parse, "lang string, chunk string, own bigint, times bigint")
    return parsed.groupBy("lang", "chunk", "own").agg(F.sum("times").alias("times"))


def _summed(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(different keys, sums of their weights), exactly."""
    if weights.sum() <= 2 * len(keys):  # few occur more than once: no need to carry weights
        keys = np.sort(np.repeat(keys, weights))
        new = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        return keys[new], np.diff(np.append(new, len(keys)))
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    new = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[new], np.add.reduceat(weights[order], new)


def phrase_counts(
    bodies: list[bytes],
    own: np.ndarray,
    times: np.ndarray,
    sizes: range,
    passed: Callable[[np.ndarray], np.ndarray] | None = None,
) -> tuple[pa.Array, np.ndarray]:
    """(phrases, counts): how often phrases of ``sizes`` words start in the chunks' own tokens.

    ``passed`` tells from the hash of a phrase of one word less than the longest whether
    it may be part of a counted one.
    """
    tokens = b" . ".join(bodies).split(b" ")
    numbers = _Numbers()
    ids = np.fromiter(map(numbers.__getitem__, tokens), np.int64, len(tokens))
    names = list(numbers)
    lengths = np.array([body.count(b" ") + 1 for body in bodies])
    first = np.cumsum(lengths + 1) - lengths - 1
    weight = np.zeros(len(ids), np.int64)  # of the phrases that start at each place
    place = np.arange(int(own.sum())) + np.repeat(first - np.cumsum(own) + own, own)
    weight[place] = np.repeat(times, own)
    word = np.append(ids != numbers.get(_STOP, -1), False)
    hashed = None
    if passed:
        hashed = np.fromiter(map(xxhash.xxh64_intdigest, names), np.uint64, len(names))[ids]
    words, phrases, counts = pa.array(names, pa.binary()), [], []
    kept = np.flatnonzero((weight > 0) & word[:-1])
    for size in range(1, sizes.stop):
        if size > 1:
            kept = kept[word[kept + size - 1]]
        if size not in sizes or not len(kept):
            continue
        if size > 1 and passed:
            kept = kept[passed(_sequence_hashes(hashed, kept, size - 1))]
            kept = kept[passed(_sequence_hashes(hashed, kept + 1, size - 1))]
            if not len(kept):
                continue
        codes, parts = ids[kept], [np.arange(len(names))]
        for i in range(1, size):
            pairs = (codes << 32) | ids[kept + i]
            if i < size - 1:
                different, codes = np.unique(pairs, return_inverse=True)
            else:
                different, sums = _summed(pairs, weight[kept])
            parts = [part[different >> 32] for part in parts] + [different & 0xFFFFFFFF]
        if size == 1:
            different, sums = _summed(codes, weight[kept])
            parts = [different]
        columns = [words.take(pa.array(part)) for part in parts]
        phrases.append(pc.binary_join_element_wise(*columns, b" ") if size > 1 else columns[0])
        counts.append(sums)
    if not phrases:
        return pa.array([], pa.binary()), np.zeros(0, np.int64)
    return pa.concat_arrays(phrases), np.concatenate(counts)


def _places(hashed: np.ndarray, lang: str, bits: int) -> np.ndarray:
    """The bit that stands for each phrase of a language, by the hash of its words."""
    own = np.uint64(xxhash.xxh64_intdigest(lang.encode()))
    return (_mixed(hashed + own) & np.uint64(bits - 1)).astype(np.int64)


def _counts(dictionary: DataFrame, sizes: range, bits: np.ndarray | None = None) -> DataFrame:
    """(lang, phrase, f) of the phrases of all different chunks; phrase '' counts words."""
    shared = None if bits is None else dictionary.sparkSession.sparkContext.broadcast(bits)

    def filtered(lang: str) -> Callable[[np.ndarray], np.ndarray]:
        bits = shared.value

        def passed(hashed: np.ndarray) -> np.ndarray:
            at = _places(hashed, lang, len(bits) * 64)
            return (bits[at >> 6] >> (at & 63)) & 1 == 1

        return passed

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, size = [], 0
        for batch in batches:
            waiting.append(batch)
            size += batch.column(1).nbytes
            if size > 6 * BLOCK:
                yield from summed(waiting)
                waiting, size = [], 0
        if waiting:
            yield from summed(waiting)

    def summed(waiting: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(waiting)
        langs = np.array(table["lang"].to_pylist(), object)
        bodies = np.array(table["chunk"].cast(pa.binary()).to_pylist(), object)
        own, times = table["own"].to_numpy(), table["times"].to_numpy()
        for lang in sorted(set(langs)):
            of = langs == lang
            phrases, counts = phrase_counts(
                bodies[of].tolist(), own[of], times[of], sizes, shared and filtered(lang)
            )
            if sizes.start == 1 and len(counts):
                single = np.array(pc.count_substring(phrases, b" ")) == 0
                phrases = pa.concat_arrays([phrases, pa.array([b""], pa.binary())])
                counts = np.append(counts, counts[single].sum())
            for at in range(0, len(counts), 100_000):
                rows = phrases.slice(at, 100_000).cast(pa.string())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(rows), pa.string()), rows, pa.array(counts[at : at + 100_000], pa.int64())],
                    names=["lang", "phrase", "f"],
                )

    counted = dictionary.mapInArrow(count, "lang string, phrase string, f bigint")
    return counted.groupBy("lang", "phrase").agg(F.sum("f").alias("f"))


def _words(phrase: str) -> Column:
    return F.size(F.split(phrase, " "))


def _filter(phrases: DataFrame, bits: int) -> np.ndarray:
    """Bits for the phrases (lang, phrase): an array of one size, whatever their number."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _Hashes()
        for batch in batches:
            at = np.zeros(batch.num_rows, np.int64)
            for i, (lang, phrase) in enumerate(zip(*(column.to_pylist() for column in batch.columns))):
                words = np.array([hashes[word] for word in phrase.encode().split(b" ")], np.uint64)
                at[i] = _places(_sequence_hashes(words, np.zeros(1, np.int64), len(words)), lang, bits)[0]
            words, bit = pa.array(at >> 6), pa.array(np.int64(1) << (at & 63))
            yield pa.RecordBatch.from_arrays([words, bit], names=["word", "bit"])

    placed = phrases.select("lang", "phrase").mapInArrow(place, "word bigint, bit bigint")
    found = placed.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    array = np.zeros(bits // 64, np.int64)
    array[found["word"].to_numpy()] = found["bits"].to_numpy()
    return array


def _phrases(dictionary: DataFrame, max_words: int, min_count: int, bits: int) -> DataFrame:
    """(lang, phrase, f) of all phrases that occur often enough, and the word counts.

    A phrase can't be more frequent than its parts. From three words on, tasks count
    only phrases whose parts pass a filter of the frequent ones; the filter has a fixed
    size, so with very many phrases it lets more pass, and the counts stay the same.
    """
    enough = (F.col("f") >= min_count) | (F.col("phrase") == "")
    found = stored(_counts(dictionary, range(1, min(max_words, 2) + 1)).where(enough))
    longest = found
    for size in range(3, max_words + 1):
        parts = longest.where((F.col("phrase") != "") & (_words("phrase") == size - 1))
        longest = stored(_counts(dictionary, range(size, size + 1), _filter(parts, bits)).where(enough))
        found = found.union(longest)
    return found


def _best_cuts(candidates: DataFrame, counts: DataFrame) -> DataFrame:
    """(lang, phrase, a, l, r, score) of each candidate at the cut with the lowest score."""
    parts = F.split("phrase", " ")
    cuts = candidates.select(
        "lang", "phrase", "a", parts.alias("words"), F.explode(F.sequence(F.lit(1), F.size(parts) - 1)).alias("k")
    ).select(
        "lang",
        "phrase",
        "a",
        "k",
        F.array_join(F.slice("words", F.lit(1), F.col("k")), " ").alias("left_part"),
        F.array_join(F.slice("words", F.col("k") + 1, F.size("words")), " ").alias("right_part"),
    )
    left = counts.select(F.col("lang").alias("left_lang"), F.col("phrase").alias("left_phrase"), F.col("f").alias("l"))
    right = left.toDF("right_lang", "right_phrase", "r")
    of_left = (F.col("lang") == F.col("left_lang")) & (F.col("left_part") == F.col("left_phrase"))
    of_right = (F.col("lang") == F.col("right_lang")) & (F.col("right_part") == F.col("right_phrase"))
    wide = {name: F.col(name).cast("decimal(18,0)") for name in ("a", "l", "r")}
    joined = cuts.join(left, of_left).join(right, of_right).withColumns({f"wide_{k}": v for k, v in wide.items()})
    score = F.expr("CAST((1000000 * (wide_a * wide_a)) DIV (wide_l * wide_r) AS BIGINT)")
    best = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("best")
    return joined.groupBy("lang", "phrase", "a").agg(best).select("lang", "phrase", "a", "best.l", "best.r", "best.score")


def _inside_longer(candidates: DataFrame, max_words: int) -> DataFrame:
    """(lang, phrase, longer): the largest count of a candidate that holds the phrase."""
    words = F.split("phrase", " ")
    inner = [
        F.when(F.size(words) >= F.lit(max(at + size, size + 1)), F.array_join(F.slice(words, at + 1, size), " "))
        for size in range(2, max_words)
        for at in range(max_words - size + 1)
    ]
    if not inner:
        inner = [F.lit(None).cast("string")]
    held = candidates.select("lang", "a", F.explode(F.array(*inner)).alias("phrase")).where("phrase IS NOT NULL")
    return held.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))


def collocations(
    documents: DataFrame,
    text_column: str = "text",
    lang_column: str = "lang",
    max_words: int = 3,
    min_count: int = 10,
    inside_percent: int = 50,
    top: int = 2000,
    modulus: int = MODULUS,
    longest: int = LONGEST,
    filter_bits: int = FILTER_BITS,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's best collocations.

    1. Tasks cut texts into overlapping chunks at triggers in the content; the dictionary
       counts each different chunk once, with its frequency.
    2. Phrases are counted inside the different chunks, weighted, where they start.
    3. Candidates are phrases of 2 to ``max_words`` words with ``a >= min_count``. The cut
       with the lowest ``1000000 * a * a / (l * r)`` counts; the arithmetic is exact for
       counts below 10 ** 16.
    4. Candidates inside a longer one with at least ``inside_percent`` of their count go.

    A null text has no words; a null language is ``und``. Repeated rows count as often as
    they come. An empty table, or one without candidates, gives no rows. Ties in score
    and count are ranked by phrase, in the order of its UTF-8 bytes.
    """
    lang = F.coalesce(F.col(lang_column).cast("string"), F.lit("und")).alias("lang")
    rows = documents.select(lang, F.col(text_column).cast("string").alias("text")).where("text IS NOT NULL")
    with written(_dictionary(rows, max_words - 1, modulus, longest)) as dictionary:
        counts = _phrases(dictionary, max_words, min_count, filter_bits)
    candidates = counts.where((F.col("phrase") != "") & (_words("phrase") > 1)).withColumnRenamed("f", "a")
    totals = counts.where("phrase = ''").select(F.col("lang").alias("of"), F.col("f").alias("n"))
    held = _inside_longer(candidates, max_words).toDF("held_lang", "held_phrase", "longer")
    scored = _best_cuts(candidates, counts.where("phrase <> ''"))
    same = (F.col("lang") == F.col("held_lang")) & (F.col("phrase") == F.col("held_phrase"))
    free = scored.join(held, same, "left").where(
        F.col("longer").isNull() | (100 * F.col("longer") < inside_percent * F.col("a"))
    )
    order = (F.desc("score"), F.desc("a"), F.asc("phrase"))
    salt = F.pmod(F.xxhash64("phrase"), F.lit(SALTS)).alias("salt")
    ranked = free.select("lang", "phrase", "a", "l", "r", "score", salt)
    ranked = ranked.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order)))
    ranked = ranked.where(F.col("rank") <= top)
    ranked = ranked.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    ranked = ranked.where(F.col("rank") <= top)
    return ranked.join(totals, F.col("lang") == F.col("of")).select(
        "lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
