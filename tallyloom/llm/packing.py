"""Packing of token sequences, shortest pack first over the histogram of lengths."""

from __future__ import annotations

import sys
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.storage import stored
from tallyloom.llm.tokens import Memo, splits_at_blanks, vocabulary

#: A pattern is a tuple of (length, times), longest first.
Pattern = tuple[tuple[int, int], ...]


def pack_histogram(histogram: dict[int, int], capacity: int) -> list[tuple[Pattern, int]]:
    """(pattern, packs) for the counts of each length.

    Lengths go from the longest to the shortest, each into the open packs with most
    room, of which there are as few as the histogram's lengths allow: packs with
    the same content are one pattern with a count. A length is spread over whole
    patterns, so that it splits at most one of them and opens at most one. The
    work depends on the capacity only, not on the number of sequences.
    """
    open_packs: dict[int, list[tuple[Pattern, int]]] = {}
    closed: list[tuple[Pattern, int]] = []

    def put(pattern: Pattern, count: int, room: int) -> None:
        if room:
            open_packs.setdefault(room, []).append((pattern, count))
        else:
            closed.append((pattern, count))

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            room = max(open_packs, default=0)
            if room < length:
                each = capacity // length
                packs, rest = divmod(left, each)
                # Those that fill whole packs of their own wait for nothing longer.
                if packs:
                    put(((length, each),), packs, capacity - each * length)
                if rest:
                    put(((length, rest),), 1, capacity - rest * length)
                break
            pattern, count = open_packs[room].pop()
            if not open_packs[room]:
                del open_packs[room]
            used = min(count, left)
            if count > used:
                open_packs.setdefault(room, []).append((pattern, count - used))
            if pattern[-1][0] == length:
                grown = (*pattern[:-1], (length, pattern[-1][1] + 1))
            else:
                grown = (*pattern, (length, 1))
            put(grown, used, room - length)
            left -= used
    for packs in open_packs.values():
        closed += packs
    return closed


def _slots(patterns: list[tuple[Pattern, int]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, end rank, times, offset, first sequence) of each length in each pattern."""
    slots, ranks, sequence = [], {}, 0
    for pattern, packs in patterns:
        offset = 0
        for length, times in pattern:
            first = ranks.get(length, 0)
            ranks[length] = first + packs * times
            slots.append((length, first, ranks[length], times, offset, sequence))
            offset += length * times
        sequence += packs
    return slots


def _encoder(path: str) -> Memo:
    """Ids of parts by the tokenizers library, many parts to a call."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    octets = vocabulary(path).octets
    lengths = np.array([len(octets.get(i, b"")) for i in range(vocabulary(path).size)])

    def together(parts: list[str]) -> list[bytes]:
        """Encode the parts as one text and cut its ids where the parts' bytes end."""
        encoding = tokenizer.encode_batch_fast(["".join(parts)], add_special_tokens=False)[0]
        ids = np.array(encoding.ids, np.uint32)
        ends = np.cumsum([len(part.encode()) for part in parts])
        stops = (4 * (np.searchsorted(np.cumsum(lengths[ids]), ends) + 1)).tolist()
        data = ids.tobytes()
        return [data[start:stop] for start, stop in zip([0, *stops[:-1]], stops)]

    def encode(parts: list[str]) -> list[bytes]:
        inner = [len(x) > 1 and x[0] == " " and not (x[1].isspace() or x[-1].isspace()) for x in parts]
        joined = [part for part, is_inner in zip(parts, inner) if is_inner]
        found = []
        for at in range(0, len(joined), 1000):
            found += together(joined[at : at + 1000])
        rest = iter(found)
        return [
            next(rest) if is_inner else array("I", tokenizer.encode(part, add_special_tokens=False).ids).tobytes()
            for part, is_inner in zip(parts, inner)
        ]

    return Memo(encode, limit=600_000)


_ENCODERS: dict[str, Memo] = {}


def _ids(path: str, text: str) -> bytes:
    if path not in _ENCODERS:
        _ENCODERS[path] = _encoder(path)
    memo = _ENCODERS[path]
    return b"".join(
        b"".join(memo.values(section)) if special is None else array("I", [special]).tobytes()
        for section, special in vocabulary(path).sections(text)
    )


def _ids_together(path: str, column: pa.Array) -> list[bytes]:
    """The ids of each text, as ``_ids`` gives them, with each different part looked up once.

    Texts whose blanks all stand alone are split and numbered by Arrow; the ids of their
    parts are put in place by arrays.
    """
    special, texts = vocabulary(path).special, column.to_pylist()
    found: list[bytes | None] = [None] * len(texts)
    simple = []
    for i, text in enumerate(texts):
        text = text or ""
        if text and splits_at_blanks(text) and not any(x in text for x in special):
            simple.append(i)
        else:
            found[i] = _ids(path, text)
    if not simple:
        return found
    if path not in _ENCODERS:
        _ENCODERS[path] = _encoder(path)
    memo = _ENCODERS[path]
    lists = pc.split_pattern(column.take(pa.array(simple)), " ")
    edges = lists.offsets.to_numpy()
    coded = lists.values.dictionary_encode()
    names, code = coded.dictionary.to_pylist(), coded.indices.to_numpy()
    # The first part of a text has no blank before it, and nothing to look up if it is empty.
    inner = np.ones(len(code), bool)
    inner[edges[:-1]] = False
    used = np.zeros(len(names), bool)
    used[code[inner]] = True
    place = np.cumsum(used) - 1
    values = memo.looked_up([names[i] for i in np.flatnonzero(used).tolist()], " ")
    firsts = [names[i] for i in code[edges[:-1]].tolist()]
    values += [value if first else b"" for first, value in zip(firsts, memo.looked_up(firsts, ""))]
    number = place[code]
    number[edges[:-1]] = int(used.sum()) + np.arange(len(firsts))
    lengths = np.array(list(map(len, values))) // 4
    flat = np.frombuffer(b"".join(values), np.uint32)
    starts = np.cumsum(lengths) - lengths
    own = lengths[number]
    ends = np.cumsum(own)
    ids = flat[np.repeat(starts[number] - ends + own, own) + np.arange(int(own.sum()))]
    stops = ends[edges[1:] - 1].tolist()
    for i, start, stop in zip(simple, [0, *stops[:-1]], stops):
        found[i] = ids[start:stop].tobytes()
    return found


#: Texts, and bytes of them, whose parts are looked up together.
TOGETHER, OCTETS = 4_000, 8_000_000


def _groups(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """(first, number) of texts in groups of bounded size; one long text is a group."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_pylist()
    at, size = 0, 0
    for place, own in enumerate(sizes):
        if place > at and (place - at == TOGETHER or size + own > OCTETS):
            yield at, place - at
            at, size = place, 0
        size += own
    if sizes:
        yield at, len(sizes) - at


def pieces(
    documents: DataFrame,
    path: str,
    capacity: int = 2048,
    end_id: int = 1,
    id_column: str = "doc_id",
    text_column: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """The pieces of every document: full sequences first, then the rest.

    (doc_id, start, length, ids_crc32, doc_tokens), and the piece's ``ids`` if asked.
    A document's ids are those of its text and the end id; it is cut only where it
    is longer than a sequence. A null text counts as empty and is one piece.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = array("I", [end_id]).tobytes()
        for batch in batches:
            for at, number in _groups(batch.column(1)):
                names, texts = (column.slice(at, number) for column in batch.columns)
                row, start, length, crc, total, ids = [], [], [], [], [], []
                for i, found in enumerate(_ids_together(path, texts)):
                    found += end
                    if sys.byteorder == "big":
                        swapped = array("I", found)
                        swapped.byteswap()
                        found = swapped.tobytes()
                    tokens = len(found) // 4
                    for a in range(0, tokens, capacity):
                        part = found[4 * a : 4 * (a + capacity)]
                        row.append(i)
                        start.append(a)
                        length.append(len(part) // 4)
                        crc.append(zlib.crc32(part))
                        total.append(tokens)
                        if with_ids:
                            ids.append(part)
                longs = [pa.array(x, pa.int64()) for x in (start, length, crc, total)]
                columns = [names.take(pa.array(row, pa.int64())), *longs]
                if with_ids:
                    columns.append(pa.array(ids, pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, names=fields)

    rows = documents.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    fields = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"] + ["ids"] * with_ids
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"
    return rows.mapInArrow(cut, schema + ", ids binary" * with_ids)


def packed(
    documents: DataFrame,
    path: str,
    capacity: int = 2048,
    end_id: int = 1,
    id_column: str = "doc_id",
    text_column: str = "text",
    with_ids: bool = False,
    ranked_together: int = 1_000,
) -> DataFrame:
    """The pieces with their ``sequence_id`` and ``offset`` in it.

    Only the histogram, one count for each length up to ``capacity``, reaches the
    driver; patterns and slots are bounded by the capacity as well and are
    broadcast. A piece finds its slot by its rank among the pieces of its length.
    Ranks are counted in buckets of about ``ranked_together`` pieces, dealt by the row,
    so that a length of very many pieces, or an id with very many rows, is ranked by
    many tasks. Repeated rows are packed as often as they occur. An empty table gives
    no rows.
    """
    cut = stored(pieces(documents, path, capacity, end_id, id_column, text_column, with_ids))
    histogram = {
        row["length"]: row["pieces"]
        for row in cut.groupBy("length").agg(F.count("*").alias("pieces")).collect()
    }
    spark = documents.sparkSession
    sizes = spark.createDataFrame(
        [(length, 1 + count // ranked_together) for length, count in histogram.items()],
        "length bigint, buckets bigint",
    )
    # The stored rows keep their order, so their numbers are the same in every pass.
    numbered = cut.withColumn("number", F.monotonically_increasing_id()).join(F.broadcast(sizes), "length")
    cut = numbered.withColumn("bucket", F.pmod(F.xxhash64("number"), "buckets")).drop("buckets")
    counts = cut.groupBy("length", "bucket").agg(F.count("*").alias("pieces"))
    earlier = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "length", "bucket", F.coalesce(F.sum("pieces").over(earlier), F.lit(0)).alias("earlier")
    )
    slots = spark.createDataFrame(
        _slots(pack_histogram(histogram, capacity)),
        "length bigint, first_rank bigint, end_rank bigint, times bigint, slot_offset bigint, first_sequence bigint",
    )
    order = Window.partitionBy("length", "bucket").orderBy("number")
    ranked = (
        cut.withColumn("rank_in_bucket", F.row_number().over(order) - 1)
        .join(offsets, ["length", "bucket"])
        .withColumn("piece_rank", F.col("rank_in_bucket") + F.col("earlier"))
    )
    within = F.col("piece_rank") - F.col("first_rank")
    matched = ranked.join(F.broadcast(slots), "length").where(
        (F.col("piece_rank") >= F.col("first_rank")) & (F.col("piece_rank") < F.col("end_rank"))
    )
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"] + ["ids"] * with_ids
    return matched.select(
        *names,
        (F.col("first_sequence") + F.floor(within / F.col("times"))).alias("sequence_id"),
        (F.col("slot_offset") + F.col("length") * (within % F.col("times"))).alias("offset"),
    )
