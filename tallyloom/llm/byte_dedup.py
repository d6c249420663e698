"""Removal of byte sequences that occur elsewhere, found with families of suffix arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.storage import ensure_checkpoints, fresh, stored, written
from tallyloom.llm.suffix_family import SuffixFamily

#: Bytes of the anchors by which sequences are dealt to shards, a power of two.
ANCHOR = 64
#: Bytes of segments that a shard holds on average.
SHARD = 16 << 20
#: An anchor with more segments than this is dealt by whole sequences.
COMMON = 50_000
#: Sequences that a segment holds at most.
RUN = 1_000
#: Bytes whose anchors are found at a time.
BLOCK = 1 << 16

_ODD = 0x9E3779B97F4A7C15
_MIX = (np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53))


def _hashes(data: np.ndarray, width: int) -> np.ndarray:
    """A hash of each ``width`` bytes in a row; ``width`` is a power of two."""
    values, done = data.astype(np.uint64) + np.uint64(1), 1
    while done < width:
        values = values[:-done] * np.uint64(pow(_ODD, done, 1 << 64)) + values[done:]
        done *= 2
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


def anchors(data: np.ndarray, document: np.ndarray, width: int, anchor: int) -> tuple[np.ndarray, ...]:
    """(hash, first, count, places) of each run of sequences with the same anchor.

    A sequence is ``width`` bytes within one document; its anchor is the smallest hash of
    ``anchor`` bytes in it, so equal sequences have equal anchors. ``places`` is 2 where
    the run may hold the anchor twice, and with it two equal sequences; else 1.
    """
    grams, goal = _hashes(data, anchor), width - anchor + 1
    least = _sliding(np.minimum, grams, goal)
    whole = document[: len(least)] == document[width - 1 :]
    changed = (least[1:] != least[:-1]) | (document[1 : len(least)] != document[: len(least) - 1]) | ~whole[:-1]
    begins = whole & np.concatenate(([True], changed))
    first = np.flatnonzero(begins)
    if not len(first):
        return (np.zeros(0, np.int64),) * 4
    run = np.cumsum(begins) - 1
    count = np.bincount(run[whole], minlength=len(first))
    # A hash is an anchor's if no sequence around it has a larger least. Two places of one
    # anchor within a run have no other anchor between them.
    edge = np.zeros(goal - 1, np.uint64)
    top = _sliding(np.maximum, np.concatenate((edge, np.where(whole, least, 0), edge)), goal)
    held = np.flatnonzero(grams == top)
    again = np.cumsum(np.concatenate(([False], grams[held[1:]] == grams[held[:-1]])))
    low = np.searchsorted(held, first)
    high = np.searchsorted(held, first + count + goal - 1) - 1
    places = 1 + (again[high] > again[low])
    return least[first].view(np.int64), first, count, places


def _cut(found: np.ndarray, first: np.ndarray, count: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs of at most ``RUN`` sequences; a repeated byte makes runs as long as its text."""
    times = -(-count // RUN)
    step = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
    first = np.repeat(first, times) + step * RUN
    count = np.minimum(np.repeat(count, times) - step * RUN, RUN)
    return np.repeat(found, times), first, count, np.repeat(places, times)


def _flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts one after another, their edges)."""
    texts = texts.cast(pa.large_binary())
    edges = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[edges[0] : edges[-1]]
    return data, edges - edges[0]


def _anchor_rows(texts: DataFrame, width: int, anchor: int) -> DataFrame:
    """(anchor, key, first, count, places) of all texts (key, text)."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0).to_numpy()
            data, edges = _flat(batch.column(1))
            document = np.repeat(np.arange(len(keys)), np.diff(edges))
            parts = []
            for at in range(0, len(data) - width + 1, BLOCK):
                stop = at + BLOCK + width - 1
                found, first, count, places = _cut(*anchors(data[at:stop], document[at:stop], width, anchor))
                of = document[at + first]
                parts.append((found, keys[of], at + first - edges[of], count, places))
            if parts:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(column), pa.int64()) for column in zip(*parts)],
                    names=["anchor", "key", "first", "count", "places"],
                )

    return texts.select("key", "text").mapInArrow(
        find, "anchor bigint, key bigint, first bigint, count bigint, places bigint"
    )


def _segments(texts: DataFrame, candidates: DataFrame, width: int) -> DataFrame:
    """(route, key, first, content) of the candidates; common ones one sequence at a time."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            route, keys, first, content, size = [], [], [], [], 0
            for key, text, spans in zip(*batch.columns):
                key, body = key.as_py(), text.as_buffer()
                for span in spans.as_py():
                    start, count = span["first"], span["count"]
                    pieces = range(start, start + count) if span["common"] else (start,)
                    length = width if span["common"] else count + width - 1
                    for at in pieces:
                        route.append(None if span["common"] else span["anchor"])
                        keys.append(key)
                        first.append(at)
                        content.append(body.slice(at, length).to_pybytes())
                    size += len(pieces) * length
                    if size > 32 << 20:
                        yield named(route, keys, first, content)
                        route, keys, first, content, size = [], [], [], [], 0
            yield named(route, keys, first, content)

    def named(route: list, keys: list, first: list, content: list) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
        return pa.RecordBatch.from_arrays(
            [pa.array(values, kind) for values, kind in zip((route, keys, first, content), kinds)],
            names=["route", "key", "first", "content"],
        )

    return (
        texts.join(candidates, "key")
        .select("key", "text", "spans")
        .mapInArrow(cut, "route bigint, key bigint, first bigint, content binary")
        .withColumn("h1", F.xxhash64("content"))
        .withColumn("h2", F.xxhash64(F.lit(1), "content"))
    )


def _indexed(segments: DataFrame, shards: int, width: int) -> DataFrame:
    """(h1, h2, at, end): the bytes of each different content that repeated sequences cover.

    Equal contents meet before the shards, combined within tasks first; one stands for all.
    """

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        family, starts, names = SuffixFamily(width), [], []
        for batch in batches:
            names.append(batch.select(["h1", "h2"]))
            for content, several in zip(batch.column("content"), batch.column("several").to_pylist()):
                starts.append(family.add(content.as_buffer(), several))
        if not starts:
            return
        begin, end = family.intervals()
        places = np.array(starts)
        of = np.searchsorted(places, begin, "right") - 1
        found = pa.Table.from_batches(names).take(pa.array(of))
        found = found.append_column("at", pa.array(begin - places[of], pa.int64()))
        found = found.append_column("end", pa.array(end - places[of], pa.int64()))
        yield from found.combine_chunks().to_batches(max_chunksize=100_000)

    contents = segments.groupBy("content", "h1", "h2").agg(
        F.coalesce(F.max("route"), F.first("h1")).alias("route"), (F.count("*") > 1).alias("several")
    )
    return contents.repartition(shards, "route").mapInArrow(search, "h1 bigint, h2 bigint, at bigint, end bigint")


def repeated_bytes(
    documents: DataFrame,
    width: int = 200,
    text_column: str = "text",
    anchor: int = ANCHOR,
    shard: int = SHARD,
    common: int = COMMON,
) -> DataFrame:
    """(digest, several, spans) of the texts that hold repeated sequences of ``width`` bytes.

    1. Equal texts are taken as one; ``several`` tells that a text occurs more than once.
    2. Every sequence is filed under its anchor. Anchors with one place in all texts hold no
       repeated sequence; the others name the candidates.
    3. The candidates' bytes meet in shards by anchor. Each shard's family of suffix
       arrays takes them in batches and finds the sequences that occur twice.
    4. ``spans`` are the bytes covered, not in order; null where there are none.
    """
    spark = documents.sparkSession
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    rows = documents.select(text.alias("text")).where(F.octet_length("text") >= width)
    different = rows.groupBy("text").agg((F.count("*") > 1).alias("several"))
    different = different.select(
        F.monotonically_increasing_id().alias("key"), F.sha2("text", 256).alias("digest"), "several", "text"
    )
    with written(different) as texts:
        with written(_anchor_rows(texts, width, anchor)) as filed:
            counts = filed.groupBy("anchor").agg(F.count("*").alias("times"), F.sum("places").alias("places"))
            counts = counts.where("places > 1").select(F.col("anchor").alias("name"), "times")
            span = F.struct("anchor", "first", "count", (F.col("times") > common).alias("common"))
            candidates = stored(
                filed.join(counts, F.col("anchor") == F.col("name"))
                .groupBy("key")
                .agg(F.collect_list(span).alias("spans"), F.sum(F.col("count") + width - 1).alias("bytes"))
            )
        total = candidates.agg(F.sum("bytes")).first()[0] or 0
        with written(_segments(texts, candidates.select("key", "spans"), width)) as segments:
            found = _indexed(segments, max(1, -(-total // shard)), width)
            places = segments.select("key", "first", F.col("h1").alias("g1"), F.col("h2").alias("g2"))
            covered = places.join(found, (F.col("g1") == F.col("h1")) & (F.col("g2") == F.col("h2")))
            interval = F.struct((F.col("first") + F.col("at")).alias("first"), (F.col("first") + F.col("end")).alias("end"))
            spans = covered.groupBy(F.col("key").alias("of")).agg(F.collect_list(interval).alias("spans"))
            spans = stored(spans)
        names = texts.select("key", "digest", "several")
        result = names.join(spans, F.col("key") == F.col("of"), "left").where("several OR spans IS NOT NULL")
        return stored(result.select("digest", "several", "spans"))


def without_repeated_bytes(
    documents: DataFrame, width: int = 200, text_column: str = "text", **options
) -> tuple[DataFrame, dict[str, str]]:
    """All rows and columns, with ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept`` as new columns.

    Removed is each byte of a text's UTF-8 that some sequence of ``width`` bytes covers
    which also starts anywhere else: in another row, also one with an equal text, or in
    the same. Sequences are judged on the input. ``n_spans`` counts the runs of removed
    bytes; ``kept`` holds the other bytes, and may begin or end within a character. A null
    text is empty, and short texts lose nothing. Ids are not looked at, so rows with null
    or equal ids are judged like any other. The second result gives the names of the new
    columns, which are changed where the documents already have them.
    """
    ensure_checkpoints(documents.sparkSession)
    found = repeated_bytes(documents, width, text_column, **options)
    d, o, s, v, r = fresh(documents, "digest", "of_digest", "spans", "several", "result")
    found = found.toDF(o, v, s)

    @F.pandas_udf("n_bytes bigint, n_removed bigint, n_spans bigint, kept binary")
    def cut(texts: pd.Series, several: pd.Series, spans: pd.Series) -> pd.DataFrame:
        rows = []
        for text, whole, intervals in zip(texts, several, spans):
            body = (text or "").encode()
            if whole is True or whole == 1:
                rows.append((len(body), len(body), 1, b""))
            elif intervals is None or not len(intervals):
                rows.append((len(body), 0, 0, body))
            else:
                parts, at, runs = [], 0, 0
                for first, end in sorted((x["first"], x["end"]) for x in intervals):
                    if first > at or not runs:
                        parts.append(body[at:first])
                        runs += 1
                    at = max(at, end)
                kept = b"".join([*parts, body[at:]])
                rows.append((len(body), len(body) - len(kept), runs, kept))
        return pd.DataFrame(rows, columns=["n_bytes", "n_removed", "n_spans", "kept"])

    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    keyed = documents.withColumn(d, F.sha2(text, 256))
    joined = keyed.join(found, F.col(d) == F.col(o), "left").withColumn(r, cut(text, F.col(v), F.col(s)))
    new = ("n_bytes", "n_removed", "n_spans", "kept")
    names = dict(zip(new, fresh(documents, *new)))
    columns = [F.col(f"`{column}`") for column in documents.columns]
    return joined.select(*columns, *(F.col(r)[n].alias(names[n]) for n in new)), names
