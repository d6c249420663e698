"""Removal of word sequences that occur earlier, found with FM-indexes over shards."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.fm_index import FMIndex
from tallyloom.llm.storage import ensure_checkpoints, fresh, stored, written

#: Words of the anchors by which windows are dealt to shards.
ANCHOR = 8
#: Words of segments that a shard holds on average.
SHARD = 600_000
#: The windows of an anchor with more segments than this are dealt to shards by their own words.
COMMON = 50_000
#: Windows that a segment holds at most.
RUN = 1_000
#: Words of a very long text whose anchors are found at a time.
BLOCK = 1_000_000

_MIX = (np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53))


def words_of(text: str | None) -> list[bytes]:
    """Runs without ASCII white space."""
    return (text or "").encode().split()


def _mixed(values: np.ndarray) -> np.ndarray:
    for factor in _MIX:
        values = (values ^ (values >> np.uint64(33))) * factor
    return values ^ (values >> np.uint64(33))


def _sliding(of: np.ufunc, values: np.ndarray, goal: int) -> np.ndarray:
    """The minimum or maximum of each ``goal`` values in a row."""
    width = 1
    while width < goal:
        step = min(width, goal - width)
        values = of(values[:-step], values[step:])
        width += step
    return values


def anchors(words: list[bytes], window: int, anchor: int) -> tuple[np.ndarray, ...]:
    """(hash, first window, windows, places) of each run of windows with the same anchor.

    A window's anchor is the smallest hash of its sequences of ``anchor`` words. It
    depends on the window's words only, so equal windows have equal anchors.
    ``places`` counts the sequences of the run's words that have this hash: equal
    windows within one run hold it at different places.
    """
    hashes = np.frombuffer(b"".join(map(xxhash.xxh64_digest, words)), ">u8").astype(np.uint64)
    grams = hashes[: len(words) - anchor + 1].copy()
    for i in range(1, anchor):
        grams = grams * np.uint64(0x9E3779B97F4A7C15) + hashes[i : len(words) - anchor + 1 + i]
    mixed, goal = _mixed(grams), window - anchor + 1
    least = _sliding(np.minimum, mixed, goal)
    first = np.flatnonzero(np.concatenate(([True], least[1:] != least[:-1])))
    # A sequence is the least of some window if no window with it has a larger least. Such
    # sequences come in the order of the runs, and those of neighbouring runs differ.
    edge = np.zeros(goal - 1, np.uint64)
    held = mixed[mixed == _sliding(np.maximum, np.concatenate((edge, least, edge)), goal)]
    starts = np.flatnonzero(np.concatenate(([True], held[1:] != held[:-1])))
    places = np.diff(np.append(starts, len(held)))
    return least[first].view(np.int64), first, np.diff(np.append(first, len(least))), places


def _cut(
    found: np.ndarray, first: np.ndarray, count: np.ndarray, places: np.ndarray
) -> tuple[np.ndarray, ...]:
    """Runs of at most ``RUN`` windows; a repeated word makes runs as long as its text.

    Each part of a run says ``places`` of the whole run, which is not less than its own.
    """
    times = -(-count // RUN)
    step = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
    first = np.repeat(first, times) + step * RUN
    count = np.minimum(np.repeat(count, times) - step * RUN, RUN)
    return np.repeat(found, times), first, count, np.repeat(places, times)


def _anchor_rows(rows: DataFrame, window: int, anchor: int) -> DataFrame:
    """(anchor, key, first, windows, places) of all rows (key, text)."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = words_of(text.as_py())
                for at in range(0, len(words) - window + 1, BLOCK):
                    runs = anchors(words[at : at + BLOCK + window - 1], window, anchor)
                    found, first, count, places = _cut(*runs)
                    parts.append((found, np.full(len(found), key), first + at, count, places))
                if sum(len(part[0]) for part in parts) > 200_000:
                    yield _batch(parts)
                    parts = []
            if parts:
                yield _batch(parts)

    return rows.select("key", "text").mapInArrow(
        find, "anchor bigint, key bigint, first bigint, windows bigint, places bigint"
    )


def _batch(parts: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate(column), pa.int64()) for column in zip(*parts)],
        names=["anchor", "key", "first", "windows", "places"],
    )


def _segments(rows: DataFrame, candidates: DataFrame, window: int) -> DataFrame:
    """(route, doc_id, key, start, words, content) of the candidates' words.

    The windows of a common anchor are segments of their own, without a route.
    """
    kind = rows.schema["doc_id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                ids, key, text, spans = (batch.column(i).slice(row, 1) for i in range(4))
                words = words_of(text[0].as_py())
                route, start, size, content = [], [], [], []
                for span in spans[0].as_py():
                    first, count, common = span["first"], span["windows"], span["common"]
                    length = window if common else count + window - 1
                    for at in range(first, first + count) if common else (first,):
                        route.append(None if common else span["anchor"])
                        start.append(at)
                        size.append(length)
                        content.append(b" ".join(words[at : at + length]))
                again = pa.array(np.zeros(len(route), np.int64))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(route, pa.int64()),
                        ids.take(again),
                        key.take(again),
                        pa.array(start, pa.int64()),
                        pa.array(size, pa.int64()),
                        pa.array(content, pa.binary()),
                    ],
                    names=["route", "doc_id", "key", "start", "words", "content"],
                )

    joined = rows.join(candidates, "key").select("doc_id", "key", "text", "spans")
    return joined.mapInArrow(
        cut, f"route bigint, doc_id {kind}, key bigint, start bigint, words bigint, content binary"
    ).withColumns({"h1": F.xxhash64("content"), "h2": F.xxhash64(F.lit(1), "content")})


def repeated_intervals(
    contents: list[bytes], document: np.ndarray, start: np.ndarray, window: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(segment, first word, end) of the words covered by windows that start earlier elsewhere.

    The contents differ; ``document`` numbers their documents in order. All are indexed,
    and all are streamed through the index: a window whose matching statistic is the
    window's length occurs several times, and is repeated unless it is the first of them.
    """
    numbers: dict[bytes, int] = {}
    sequences = [
        np.array([numbers.setdefault(word, len(numbers) + 1) for word in content.split()], np.int64)
        for content in contents
    ]
    index = FMIndex(sequences)
    windows = np.array([len(s) - window + 1 for s in sequences], np.int64)
    source = np.repeat(np.arange(len(contents)), windows)
    offset = np.arange(len(source)) - np.repeat(np.cumsum(windows) - windows, windows)
    same = index.matches(index.starts[source] + offset, window)
    when = (document[source].astype(np.int64) << 40) + start[source] + offset
    earlier = np.zeros(len(source), bool)
    matched = np.flatnonzero(same >= 0)
    if len(matched):
        ranked = matched[np.lexsort((when[matched], same[matched]))]
        new = np.concatenate(([True], same[ranked][1:] != same[ranked][:-1]))
        least = when[ranked][np.maximum.accumulate(np.where(new, np.arange(len(ranked)), 0))]
        earlier[ranked] = when[ranked] > least
    joined = source[1:] == source[:-1]
    runs = np.flatnonzero(earlier & ~np.concatenate(([False], earlier[:-1] & joined)))
    stops = np.flatnonzero(earlier & ~np.concatenate((earlier[1:] & joined, [False])))
    segment = source[runs]
    return segment, start[segment] + offset[runs], start[segment] + offset[stops] + window


def _indexed(heads: DataFrame, shards: int, window: int) -> DataFrame:
    """(doc_id, key, first, end) of the repeated words of different contents, by shard."""
    kind = heads.schema["doc_id"].dataType.simpleString()

    def search(table: pa.Table) -> pa.Table:
        rows, first, end = repeated_intervals(
            table["content"].to_pylist(), _document_order(table), table["start"].to_numpy(), window
        )
        taken = table.select(["doc_id", "key"]).take(pa.array(rows))
        return taken.append_column("first", pa.array(first, pa.int64())).append_column(
            "end", pa.array(end, pa.int64())
        )

    shard = F.pmod(F.xxhash64("route"), F.lit(shards)).alias("shard")
    return (
        heads.select(shard, "doc_id", "key", "start", "content")
        .groupBy("shard")
        .applyInArrow(search, f"doc_id {kind}, key bigint, first bigint, end bigint")
    )


def _document_order(table: pa.Table) -> np.ndarray:
    """A number per row that orders (doc_id, key) with null ids first; equal for equal pairs."""
    frame = pd.DataFrame({"doc_id": table["doc_id"].to_pandas(), "key": table["key"].to_numpy()})
    ids = frame["doc_id"].rank(method="dense", na_option="top").to_numpy()
    order = np.lexsort((frame["key"].to_numpy(), ids))
    ids, keys = ids[order], frame["key"].to_numpy()[order]
    changed = np.concatenate(([0], np.cumsum((ids[1:] != ids[:-1]) | (keys[1:] != keys[:-1]))))
    numbers = np.empty(len(order), np.int64)
    numbers[order] = changed
    return numbers


def _one_per_text(rows: DataFrame) -> DataFrame:
    """The rows (doc_id, key, text), those that repeat both id and text once."""
    repeated = stored(rows.groupBy("key").agg(F.count("*").alias("times")).where("times > 1").select("key"))
    if repeated.isEmpty():
        return rows
    several = rows.join(repeated, "key", "left_semi").groupBy("doc_id", "key", "text").agg(F.count("*"))
    return rows.join(repeated, "key", "left_anti").unionByName(several.select("doc_id", "key", "text"))


def removals(
    documents: DataFrame,
    window: int = 20,
    id_column: str = "doc_id",
    text_column: str = "text",
    anchor: int = ANCHOR,
    shard: int = SHARD,
    common: int = COMMON,
) -> DataFrame:
    """(doc_id, key, spans): the intervals of repeated words of each document that has some.

    1. Every window of a document is filed under its anchor. Anchors that occur at one
       place in all documents hold no repeated window; the others name the candidates.
    2. Equal contents of candidates meet, combined within tasks first. All but the first
       are repeated as a whole, however many there are.
    3. The different contents meet in shards by anchor, so that equal windows share a
       shard; those of common anchors by window. Each shard builds an FM-index and
       streams its contents through it by backward search.
    4. A window whose words start earlier elsewhere marks its words.

    ``key`` tells rows with the same id but other texts apart; rows that repeat both
    are one document.
    """
    key = F.xxhash64(F.col(id_column), F.col(text_column))
    rows = documents.select(
        F.col(id_column).alias("doc_id"), key.alias("key"), F.col(text_column).alias("text")
    )
    rows = _one_per_text(rows.where("text IS NOT NULL"))
    with written(_anchor_rows(rows.select("key", "text"), window, anchor)) as filed:
        counts = filed.groupBy("anchor").agg(
            F.count("*").alias("times"), F.sum("places").alias("places"), F.max("anchor").alias("name")
        )
        counts = counts.where("places > 1").select("name", "times")
        span = F.struct("anchor", "first", "windows", (F.col("times") > common).alias("common"))
        words = F.when(F.col("times") > common, F.col("windows") * window).otherwise(F.col("windows") + window - 1)
        candidates = stored(
            filed.join(counts, filed["anchor"] == counts["name"])
            .groupBy("key")
            .agg(F.collect_list(span).alias("spans"), F.sum(words).alias("words"))
        )
    total = candidates.agg(F.sum("words")).first()[0] or 0
    with written(_segments(rows, candidates.select("key", "spans"), window)) as segments:
        place = F.struct("doc_id", "key", "start")
        heads = segments.groupBy("content", "h1", "h2").agg(
            F.min(place).alias("least"), F.max("route").alias("route"), F.count("*").alias("times")
        )
        with written(heads) as heads:
            first = heads.where("times > 1").select(F.col("h1").alias("g1"), F.col("h2").alias("g2"), "least")
            later = (
                segments.select(place.alias("place"), "doc_id", "key", "start", "words", "h1", "h2")
                .join(first, (F.col("h1") == F.col("g1")) & (F.col("h2") == F.col("g2")))
                .where("place > least")
                .select("doc_id", "key", F.col("start").alias("first"), (F.col("start") + F.col("words")).alias("end"))
            )
            shards = max(1, -(-total // shard))
            different = heads.select("least.*", "content", F.coalesce("route", "h1").alias("route"))
            return stored(
                _indexed(different, shards, window)
                .unionByName(later)
                .groupBy("doc_id", "key")
                .agg(F.collect_list(F.struct("first", "end")).alias("spans"))
            )


def without_repeats(
    documents: DataFrame,
    window: int = 20,
    id_column: str = "doc_id",
    text_column: str = "text",
    **options,
) -> tuple[DataFrame, dict[str, str]]:
    """All rows and columns, with ``n_words``, ``n_removed`` and ``kept`` text as new columns.

    Removed is each word that some window covers whose words also start earlier: in
    a row with a smaller id (null ids first; of equal ids, the text with the smaller
    hash), or earlier in the same row. Windows are judged on the input. Rows that
    repeat both id and text are one document and get the same result. ``kept``
    joins the other words by one space; it is empty for null and empty texts. The
    second result gives the names of the new columns, which are changed where the
    documents already have them.
    """
    ensure_checkpoints(documents.sparkSession)
    k, i, s, r = fresh(documents, "key", "same_id", "spans", "result")
    found = removals(documents, window, id_column, text_column, **options).select(
        F.col("doc_id").alias(i), F.col("key").alias(k), F.col("spans").alias(s)
    )

    @F.pandas_udf("n_words bigint, n_removed bigint, kept string")
    def cut(texts: pd.Series, spans: pd.Series) -> pd.DataFrame:
        words, removed, kept = [], [], []
        for text, intervals in zip(texts, spans):
            parts = words_of(text)
            words.append(len(parts))
            if intervals is not None and len(intervals):
                gone = np.zeros(len(parts), bool)
                for interval in intervals:
                    gone[interval["first"] : interval["end"]] = True
                parts = [parts[at] for at in np.flatnonzero(~gone)]
            removed.append(words[-1] - len(parts))
            kept.append(b" ".join(parts).decode())
        return pd.DataFrame({"n_words": words, "n_removed": removed, "kept": kept})

    keyed = documents.withColumn(k, F.xxhash64(F.col(id_column), F.col(text_column)))
    joined = keyed.join(
        found, (keyed[k] == found[k]) & keyed[id_column].eqNullSafe(found[i]), "left"
    ).select(*(keyed[f"`{column}`"] for column in documents.columns), s)
    marked = joined.withColumn(r, cut(text_column, s))
    names = dict(zip(("n_words", "n_removed", "kept"), fresh(documents, "n_words", "n_removed", "kept")))
    return (
        marked.select(*(F.col(f"`{c}`") for c in documents.columns), *(F.col(r)[n].alias(names[n]) for n in names)),
        names,
    )


def remove_repeats(
    documents: DataFrame, window: int = 20, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """The documents with repeated passages cut out of their texts; columns unchanged.

    Texts without such passages stay as they are, byte for byte, and a document that
    loses all its words stays with an empty text. ``n_chars``, where there is such
    a column, follows the text.
    """
    marked, names = without_repeats(documents, window, id_column, text_column)
    changed = F.col(names["n_removed"]) > 0
    new = {text_column: F.when(changed, F.col(names["kept"])).otherwise(F.col(text_column))}
    if "n_chars" in documents.columns and text_column != "n_chars":
        kind = documents.schema["n_chars"].dataType
        new["n_chars"] = F.when(changed, F.length(names["kept"]).cast(kind)).otherwise(F.col("n_chars"))
    return marked.withColumns(new).select(*(F.col(f"`{column}`") for column in documents.columns))
