"""Near-duplicates by SimHash fingerprints and multi-index hashing."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from tallyloom.llm.components import connected_components
from tallyloom.llm.storage import fresh, stored

BITS = 64
SEED = 42
#: Segments of a fingerprint. With 2, a pair within 3 bits differs by at most one bit in one of
#: them, and 32 bits a segment keep the tables' buckets small for billions of texts.
SEGMENTS = 2
#: Shingles hashed at a time, so that a very long text needs no more memory than a short one.
BLOCK = 50_000


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """The 64 majority bits of the hashes of all word shingles, as a signed integer.

    Words are runs without ASCII white space; A-Z are lower-cased. A text of fewer
    words than a shingle is one shingle; one without words has fingerprint zero.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    width = min(shingle, len(words))
    first, last = starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist()
    digest, view = xxhash.xxh64_intdigest, joined
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(first), BLOCK):
        block = [digest(view[a:b], SEED) for a, b in zip(first[at : at + BLOCK], last[at : at + BLOCK])]
        octets = np.array(block, "<u8").view(np.uint8).reshape(-1, 8)
        bits = np.unpackbits(octets, axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.uint32)
    majority = np.packbits(2 * ones > len(first), bitorder="little")
    return int(majority.view("<i8")[0])


def fingerprints(text: Column, shingle: int = 3) -> Column:
    @F.pandas_udf(LongType())
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(x, shingle) for x in texts], dtype="int64")

    return of(text)


def _segments(count: int) -> list[tuple[int, int]]:
    """(shift, width) of each part of a fingerprint."""
    edges = [BITS * i // count for i in range(count + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def _part(fp: Column, shift: int, width: int) -> Column:
    return F.shiftrightunsigned(fp, shift).bitwiseAND(F.lit((1 << width) - 1))


def ball(width: int, radius: int) -> list[int]:
    """The changes of ``width`` bits in which at most ``radius`` of them flip."""
    return [
        sum(1 << bit for bit in flips)
        for size in range(radius + 1)
        for flips in combinations(range(width), size)
    ]


def near_pairs(nodes: DataFrame, max_distance: int = 3, segments: int = SEGMENTS) -> DataFrame:
    """(a, b), a < b: all pairs of different fingerprints ``fp`` within the distance.

    If the nodes have a ``label``, the pairs of different labels that such
    fingerprints have; fingerprints of one label are not paired. Values under which
    all fingerprints that are filed or looked up have one label drop out before the
    join, so a large group that is linked already costs nothing there.

    With q, r = divmod(max_distance, segments), a pair within the distance differs by
    at most q bits in one of the first r + 1 segments, or by at most q - 1 in one of
    the others. Every fingerprint is filed under its segments' values, and looks up
    the ball of that radius around each of them. Of a pair, only the side whose
    changed value is larger looks up the other. The complete distance is tested
    inside the join, so only links leave it.
    """
    quotient, remainder = divmod(max_distance, segments)
    filed, probes = [], []
    fp = F.col("fp")
    own, other = [fp.alias("a")], [fp.alias("b")]
    a, b = "a", "b"
    if "label" in nodes.columns:
        own, other = [*own, F.col("label").alias("a_label")], [*other, F.col("label").alias("b_label")]
        a, b = "a_label", "b_label"
    for number, (shift, width) in enumerate(_segments(segments)):
        radius = quotient if number <= remainder else quotient - 1
        if radius < 0:
            continue
        masks = ball(width, radius)
        label = F.lit(number).alias("segment")
        filed.append(nodes.select(label, _part(fp, shift, width).alias("value"), *other))
        around = nodes.select(
            label,
            _part(fp, shift, width).alias("own"),
            F.explode(F.array(*map(F.lit, map(int, masks))).cast("array<bigint>")).alias("mask"),
            *own,
        ).where(F.col("own").bitwiseXOR(F.col("mask")) >= F.col("own"))
        changed = F.col("own").bitwiseXOR(F.col("mask")).alias("value")
        labels = [name for name in around.columns if name not in ("segment", "own", "mask")]
        probes.append(around.select("segment", changed, *labels))
    left, right = probes[0], filed[0]
    for more_probes, more_filed in zip(probes[1:], filed[1:]):
        left, right = left.union(more_probes), right.union(more_filed)
    close = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_distance
    if "label" in nodes.columns:
        both = left.select("segment", "value", F.col(a).alias("label"), F.lit(0).alias("filed")).union(
            right.select("segment", "value", F.col(b).alias("label"), F.lit(1).alias("filed"))
        )
        mixed = both.groupBy("segment", "value").agg(
            F.min("label").alias("low"), F.max("label").alias("high"), F.max("filed").alias("filed")
        )
        mixed = stored(mixed.where("low < high AND filed = 1").select("segment", "value"))
        mixed = mixed.hint("merge")
        left, right = left.join(mixed, ["segment", "value"]), right.join(mixed, ["segment", "value"])
    found = left.join(right, ["segment", "value"]).where(close & (F.col(a) != F.col(b)))
    return found.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct()


def stars(nodes: DataFrame, max_distance: int = 3, segments: int = SEGMENTS) -> DataFrame:
    """(a, b): links of fingerprints to one in the middle of those that share a segment.

    The middle is the fingerprint nearest to the majority of the bucket's bits. A bucket
    gives at most one link a member, whatever its size, so what a large group of near
    copies costs grows with its members and not with their pairs.
    """
    filed = [
        nodes.select(F.lit(number).alias("segment"), _part(F.col("fp"), *segment).alias("value"), "fp")
        for number, segment in enumerate(_segments(segments))
    ]
    filed = reduce(DataFrame.union, filed)
    shared = filed.groupBy("segment", "value").agg(F.count("*").alias("members"), _ones(F.col("fp")).alias("ones"))
    shared = shared.where("members > 1").select("segment", "value", _majority("ones", "members").alias("most"))
    held = stored(filed.join(shared.hint("merge"), ["segment", "value"]))
    away = F.bit_count(F.col("fp").bitwiseXOR(F.col("most")))
    middles = held.groupBy("segment", "value").agg(F.min(F.struct(away.alias("away"), "fp")).alias("nearest"))
    middles = middles.select("segment", "value", F.col("nearest.fp").alias("middle"))
    close = F.bit_count(F.col("fp").bitwiseXOR(F.col("middle"))) <= max_distance
    links = held.join(middles.hint("merge"), ["segment", "value"]).where(close & (F.col("fp") != F.col("middle")))
    return links.select(F.col("fp").alias("a"), F.col("middle").alias("b"))


def _ones(fp: Column) -> Column:
    """How many values of a group have each bit: 32 sums of two bits, of up to 2 ** 31 values."""
    low = [F.shiftrightunsigned(fp, bit).bitwiseAND(F.lit(0x100000001)) for bit in range(BITS // 2)]
    return F.array(*map(F.sum, low))


def _majority(ones: str, members: str) -> Column:
    """The bits that more than half of a group's values have."""
    return F.expr(
        f"aggregate(sequence(0, {BITS // 2 - 1}), 0L, (bits, i) -> bits"
        f" | if(2 * ({ones}[i] & 4294967295L) > {members}, shiftleft(1L, i), 0L)"
        f" | if(2 * shiftrightunsigned({ones}[i], 32) > {members}, shiftleft(1L, i + {BITS // 2}), 0L))"
    )


#: Steps from star to star by which labels are shortened before pairs are looked up.
JUMPS = 3


def _labels(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """(fp, first, label): the same label only for fingerprints that stars connect.

    Each fingerprint points to the middle of one of its stars; a label is what is reached
    after some steps.
    """
    to = links.groupBy("a").agg(F.min("b").alias("label"))
    labelled = nodes.select("fp", "first").join(to.hint("merge"), F.col("fp") == F.col("a"), "left")
    labelled = labelled.select("fp", "first", F.coalesce("label", "fp").alias("label"))
    step = to.toDF("at", "next")
    for _ in range(JUMPS):
        labelled = labelled.join(step.hint("merge"), F.col("label") == F.col("at"), "left").select(
            "fp", "first", F.coalesce("next", "label").alias("label")
        )
    return labelled


def _components(nodes: DataFrame, max_distance: int, segments: int) -> DataFrame:
    """(fp, component_id) from (fp, first): ``first`` is the smallest id of a fingerprint.

    Stars join most of a group; then every pair within the distance whose ends have other
    labels is found by looking up the balls around the segments. Labels that a star or a
    pair links are one component.
    """
    links = stored(stars(nodes, max_distance, segments))
    labelled = stored(_labels(nodes, links))
    pairs = near_pairs(labelled.select("fp", "label"), max_distance, segments)
    ends = labelled.select(F.col("fp").alias("end"), "label")
    named = links.join(ends.toDF("a", "a_label").hint("merge"), "a").join(ends.toDF("b", "b_label").hint("merge"), "b")
    named = named.where("a_label <> b_label").select(F.col("a_label").alias("a"), F.col("b_label").alias("b"))
    joined = connected_components(pairs.union(named)).hint("merge")
    labelled = labelled.join(joined, labelled["label"] == joined["node"], "left").select(
        "fp", "first", F.coalesce("component", "label").alias("label")
    )
    least = labelled.groupBy("label").agg(F.min("first").alias("component_id"))
    return labelled.join(least.hint("merge"), "label").select("fp", "component_id")


def _grouped(
    documents: DataFrame,
    id_column: str,
    text_column: str,
    shingle: int,
    max_distance: int,
    segments: int,
    digests: Sequence[Column] = (),
) -> DataFrame:
    """(doc_id, fp, component_id) and the given digests of every document."""
    prints = stored(
        documents.select(
            F.col(id_column).alias("doc_id"),
            fingerprints(F.col(text_column), shingle).alias("fp"),
            *(digest.alias(f"digest{i}") for i, digest in enumerate(digests)),
        )
    )
    nodes = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("first")))
    groups = stored(_components(nodes, max_distance, segments))
    return prints.join(groups.hint("merge"), "fp").select(*prints.columns, "component_id")


def simhash_groups(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    shingle: int = 3,
    max_distance: int = 3,
    segments: int = SEGMENTS,
) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every document.

    A null text has no words, and so fingerprint zero, linked like any other. A
    null id is never a component's id unless the component has no other. Repeated
    rows come out as often as they came in. An empty table gives no rows.
    """
    groups = _grouped(documents, id_column, text_column, shingle, max_distance, segments)
    return groups.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one_of_group(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    shingle: int = 3,
    max_distance: int = 3,
    segments: int = SEGMENTS,
) -> DataFrame:
    """The documents without all of a near-duplicate group but the one with the smallest id.

    Each row is judged by its own text's group: rows that share an id, or have none,
    may be in several groups. Rows of one group that share its smallest id all stay.
    A null id stays only in a group without other ids.
    """
    i, d, e = fresh(documents, "same_id", "digest0", "digest1")
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    digests = F.xxhash64(text), F.xxhash64(F.lit(1), text)
    groups = _grouped(documents, id_column, text_column, shingle, max_distance, segments, digests)
    dropped = groups.where(~F.col("doc_id").eqNullSafe(F.col("component_id")))
    # Fingerprints are costly, so rows are found again by the digest of their text.
    dropped = stored(dropped.select("doc_id", "digest0", "digest1").distinct().toDF(i, f"{d}_", f"{e}_"))
    named = documents.withColumns({d: digests[0], e: digests[1]})
    same = named[f"`{id_column}`"].eqNullSafe(dropped[i]) & (named[d] == dropped[f"{d}_"]) & (named[e] == dropped[f"{e}_"])
    kept = named.join(dropped, same, "left_anti")
    return kept.select(*(F.col(f"`{column}`") for column in documents.columns))
