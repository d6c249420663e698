"""A trie of conversations, with totals of subtrees rolled up in bands of depth."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.storage import stored

#: Levels of the trie in a band.
BAND = 8
#: Places of a conversation that are numbered together; longer ones are cut into such blocks.
BLOCK = 1024
#: Ids that are joined to one text before a node's texts are hashed one after another.
IDS = 4096

_KEY = ("k1", "k2")


def numbered_turns(
    turns: DataFrame, id_column: str, turn_column: str, role_column: str, text_column: str
) -> DataFrame:
    """(conv, place, role, text): turns in order of number, null first, then role and text.

    Places start at 1. They are counted in blocks of turn numbers, so that one very long
    conversation is sorted by many tasks.
    """
    rows = turns.select(
        F.col(id_column).cast("bigint").alias("conv"),
        F.col(turn_column).alias("turn"),
        F.coalesce(F.col(role_column), F.lit("")).alias("role"),
        F.coalesce(F.col(text_column), F.lit("")).alias("text"),
    ).where("conv IS NOT NULL")
    rows = rows.withColumn("block", F.coalesce(F.floor(F.col("turn") / BLOCK), F.lit(-(1 << 62))))
    inside = Window.partitionBy("conv", "block").orderBy(F.asc_nulls_first("turn"), "role", "text")
    earlier = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sizes = rows.groupBy("conv", "block").agg(F.count("*").alias("size"))
    before = sizes.select("conv", "block", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("before"))
    local = rows.withColumn("place", F.row_number().over(inside))
    return local.join(before, ["conv", "block"]).select(
        "conv", (F.col("place") + F.col("before")).alias("place"), "role", "text"
    )


def with_openings(numbered: DataFrame, of: Column, length: Column, most: int) -> DataFrame:
    """(conv, place, role, text) with each conversation's first turns taken from another.

    ``of`` and ``length`` give, from ``conv``, the other conversation and how many turns, at
    most ``most``, are taken. They replace as many of its own, if it has so many. One row
    with place 0 stands for each conversation itself, also where no turns are left.
    """
    lengths = numbered.groupBy("conv").agg(F.count("*").alias("turns"))
    shared = lengths.select(F.col("conv").alias("source"), F.col("turns").alias("source_turns"))
    plan = lengths.select("conv", of.alias("of"), length.alias("length"))
    plan = plan.join(shared, F.col("of") == F.col("source"), "left").select(
        "conv", "of", "length", F.least("length", F.coalesce("source_turns", F.lit(0))).alias("opening")
    )
    opening = numbered.where(F.col("place") <= most).toDF("source", "place", "role", "text")
    opening = opening.join(plan, (F.col("source") == F.col("of")) & (F.col("place") <= F.col("opening")))
    own = numbered.join(plan, "conv").where(F.col("place") > F.col("length"))
    place = F.col("opening") + F.col("place") - F.col("length")
    itself = plan.select("conv", F.lit(0).cast("bigint").alias("place"), F.lit("").alias("role"), F.lit("").alias("text"))
    return (
        opening.select("conv", F.col("place").cast("bigint").alias("place"), "role", "text")
        .union(own.select("conv", place.cast("bigint").alias("place"), "role", "text"))
        .union(itself)
    )


def _prefixes(rows: DataFrame) -> DataFrame:
    """(conv, depth, k1, k2, p1, p2, bytes, last) of every prefix of every conversation.

    A prefix is named by 128 bits: the exclusive or of the SHA-256 digests of its turns,
    each taken together with its place. ``p1`` and ``p2`` name the prefix without its last
    turn, ``last`` marks whole conversations. The bits are summed up in blocks of places.
    """
    encoded = F.concat(F.concat_ws(":", "place", F.octet_length("role"), "role"), F.col("text"))
    digest = F.sha2(F.encode(encoded, "UTF-8"), 256)

    def part(start: int) -> Column:
        number = F.conv(F.substring("digest", start, 16), 16, -10).cast("bigint")
        return F.when(F.col("place") == 0, F.lit(0).cast("bigint")).otherwise(number)

    hashed = rows.select(
        "conv", "place", digest.alias("digest"), F.octet_length("text").cast("bigint").alias("bytes")
    ).select("conv", "place", "bytes", part(1).alias("h1"), part(17).alias("h2"))
    hashed = hashed.withColumn("block", F.floor(F.col("place") / BLOCK))
    blocks = hashed.groupBy("conv", "block").agg(F.bit_xor("h1").alias("b1"), F.bit_xor("h2").alias("b2"))
    whole = Window.partitionBy("conv")
    earlier = whole.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("bigint")
    before = blocks.select(
        "conv",
        "block",
        F.coalesce(F.bit_xor("b1").over(earlier), zero).alias("b1"),
        F.coalesce(F.bit_xor("b2").over(earlier), zero).alias("b2"),
        F.max("block").over(whole).alias("last_block"),
    )
    inside = Window.partitionBy("conv", "block")
    running = inside.orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    local = hashed.select(
        "*",
        F.bit_xor("h1").over(running).alias("x1"),
        F.bit_xor("h2").over(running).alias("x2"),
        F.max("place").over(inside).alias("last_place"),
    ).join(before, ["conv", "block"])
    keyed = local.withColumns({"k1": F.col("x1").bitwiseXOR(F.col("b1")), "k2": F.col("x2").bitwiseXOR(F.col("b2"))})
    return keyed.select(
        "conv",
        F.col("place").alias("depth"),
        "k1",
        "k2",
        F.col("k1").bitwiseXOR(F.col("h1")).alias("p1"),
        F.col("k2").bitwiseXOR(F.col("h2")).alias("p2"),
        "bytes",
        ((F.col("block") == F.col("last_block")) & (F.col("place") == F.col("last_place"))).alias("last"),
    )


def _ancestors(prefixes: DataFrame, step: int, band: int) -> DataFrame:
    """(way, stretch, a1, a2, above): prefixes at every ``step``-th depth, by conversation and band."""
    at = F.col("depth") / step
    return prefixes.where(F.col("depth") % step == 0).select(
        F.col("conv").alias("way"),
        F.floor(at / band).alias("stretch"),
        F.col("k1").alias("a1"),
        F.col("k2").alias("a2"),
        F.col("depth").alias("above"),
    )


def _summed(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("a1", "a2").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))


def _rolled_up(nodes: DataFrame, prefixes: DataFrame, deepest: int, band: int) -> DataFrame:
    """(k1, k2, leaves, saved) summed over the subtree of each node.

    Within a band of ``band`` levels every node adds its own figures to its ancestors in
    that band; a node's ancestors are the prefixes of its first conversation. The roots
    of all bands, with the sums of their bands, are a trie again, ``band`` times less
    deep, and are rolled up in the same way. Their complete sums then go to the
    ancestors in the band above. So a node meets ``band`` ancestors at most in each of
    log(depth) rounds.
    """
    step, levels = 1, []
    current = nodes.select("conv", "depth", "k1", "k2", "leaves", "saved")
    while True:
        above = _ancestors(prefixes, step, band)
        same = (F.col("conv") == F.col("way")) & (F.floor(F.col("depth") / step / band) == F.col("stretch"))
        pairs = current.join(above, same & (F.col("above") <= F.col("depth")))
        sums = stored(_summed(pairs))
        named = (F.col("k1") == F.col("a1")) & (F.col("k2") == F.col("a2"))
        places = current.select("conv", "depth", *_KEY)
        current = stored(places.join(sums, named).select("conv", "depth", *_KEY, "leaves", "saved"))
        levels.append((step, current))
        step *= band
        if deepest < step:
            break
        current = current.where(F.col("depth") % step == 0)
    _, total = levels.pop()
    while levels:
        step, sums = levels.pop()
        roots = total.where("depth > 0")
        above = _ancestors(prefixes, step, band)
        before = F.floor((F.col("depth") / step - 1) / band)
        passed = _summed(roots.join(above, (F.col("conv") == F.col("way")) & (before == F.col("stretch"))))
        passed = passed.toDF("a1", "a2", "more_leaves", "more_saved")
        named = (F.col("k1") == F.col("a1")) & (F.col("k2") == F.col("a2"))
        total = stored(
            sums.join(passed, named, "left").select(
                "conv",
                "depth",
                *_KEY,
                (F.col("leaves") + F.coalesce("more_leaves", F.lit(0))).alias("leaves"),
                (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved"),
            )
        )
    return total.select(*_KEY, "leaves", "saved")


def _digests(ends: DataFrame) -> DataFrame:
    """(e1, e2, ends_sha256): the digest of the ascending ids of each node (k1, k2, conv).

    A digest takes its bytes in order. So that a node with very many ids costs one task
    only the hashing, the ids are sorted and joined to texts by ranges first; the task
    holds one batch of texts at a time.
    """

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, last = [], None
            for k1, k2, conv in zip(*(column.to_pylist() for column in batch.columns)):
                if last is None or last[:2] != (k1, k2) or len(last[3]) == IDS:
                    last = (k1, k2, conv, [])
                    rows.append(last)
                last[3].append(str(conv))
            names = ["k1", "k2", "first", "ids"]
            columns = list(zip(*((k1, k2, first, ",".join(ids)) for k1, k2, first, ids in rows)))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        for batch in batches:
            done = []
            for k1, k2, ids in zip(*(column.to_pylist() for column in batch.columns)):
                if node == (k1, k2):
                    state.update(b"," + ids.encode())
                    continue
                if node is not None:
                    done.append((*node, state.hexdigest()))
                node, state = (k1, k2), hashlib.sha256(ids.encode())
            yield named(done)
        if node is not None:
            yield named([(*node, state.hexdigest())])

    def named(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows)) or [(), (), ()]
        kinds = (pa.int64(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)], names=["e1", "e2", "ends_sha256"]
        )

    order = ("k1", "k2", "conv")
    ranges = ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
    texts = ranges.mapInArrow(joined, "k1 bigint, k2 bigint, first bigint, ids string")
    texts = texts.repartition(*_KEY).sortWithinPartitions("k1", "k2", "first")
    return texts.select("k1", "k2", "ids").mapInArrow(hashed, "e1 bigint, e2 bigint, ends_sha256 string")


def prefix_trie(rows: DataFrame, band: int = BAND) -> DataFrame:
    """The nodes of the trie of conversations (conv, place, role, text), places from 0.

    Per node: ``conv_id``, its smallest member; ``depth``; ``parent_conv_id``, null for the
    root; ``n_convs``, members; ``n_children``; ``n_leaves`` of its subtree; ``saved_tokens``,
    summed over its subtree, (members - 1) times the UTF-8 bytes of the last text;
    ``ends_sha256`` of the ids of conversations that end there, ascending, joined by
    commas. No conversations, no nodes, not even a root.
    """
    prefixes = stored(_prefixes(rows))
    nodes = stored(
        prefixes.groupBy(*_KEY).agg(
            F.min("conv").alias("conv"),
            F.max("depth").alias("depth"),
            F.max("p1").alias("p1"),
            F.max("p2").alias("p2"),
            F.count("*").alias("n_convs"),
            F.max("bytes").alias("bytes"),
        )
    )
    below = nodes.where("depth > 0")
    children = below.groupBy(F.col("p1").alias("c1"), F.col("p2").alias("c2")).agg(F.count("*").alias("n_children"))
    parents = nodes.select(
        F.col("k1").alias("u1"), F.col("k2").alias("u2"), F.col("conv").alias("parent_conv_id")
    )
    of_children = (F.col("k1") == F.col("c1")) & (F.col("k2") == F.col("c2"))
    of_parent = (F.col("depth") > 0) & (F.col("p1") == F.col("u1")) & (F.col("p2") == F.col("u2"))
    linked = nodes.join(children, of_children, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    own = linked.select(
        "conv",
        "depth",
        *_KEY,
        (F.col("n_children") == 0).cast("bigint").alias("leaves"),
        ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved"),
    )
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    sums = _rolled_up(own, prefixes, deepest, band).toDF("s1", "s2", "n_leaves", "saved_tokens")
    ends = _digests(stored(prefixes.where("last").select(*_KEY, "conv")))
    return (
        linked.join(parents, of_parent, "left")
        .join(sums, (F.col("k1") == F.col("s1")) & (F.col("k2") == F.col("s2")))
        .join(ends, (F.col("k1") == F.col("e1")) & (F.col("k2") == F.col("e2")), "left")
        .select(
            F.col("conv").alias("conv_id"),
            "depth",
            "parent_conv_id",
            "n_convs",
            "n_children",
            "n_leaves",
            "saved_tokens",
            F.coalesce("ends_sha256", F.sha2(F.lit(b""), 256)).alias("ends_sha256"),
        )
    )


def conversation_trie(
    conversations: DataFrame,
    id_column: str = "conv_id",
    turn_column: str = "turn",
    role_column: str = "role",
    text_column: str = "text",
    group: int = 5,
    spread: int = 9,
    band: int = BAND,
) -> DataFrame:
    """The trie of conversations whose openings are shared within groups of ids.

    Conversation c begins with the first h turns of c - c % ``group``, all if it has fewer
    and none if there is no such conversation, and goes on with its own after the h-th;
    h is the CRC-32 of the decimal id modulo ``spread``. Null roles and texts are empty;
    turns without an id belong to no conversation and are left out. Of turns with one
    number, those with the smaller role, then text, come first; repeated rows are turns
    of their own. Other columns are ignored.
    """
    numbered = stored(numbered_turns(conversations, id_column, turn_column, role_column, text_column))
    conv = F.col("conv")
    length = F.crc32(conv.cast("string").cast("binary")) % spread
    return prefix_trie(with_openings(numbered, conv - conv % group, length, spread - 1), band)
