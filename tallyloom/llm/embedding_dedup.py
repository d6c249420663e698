"""Near-duplicate vectors by random-hyperplane sign hashing and exact cosines."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from tallyloom.llm.components import connected_components
from tallyloom.llm.storage import stored

#: Hash tables, and hyperplanes in each. A pair at cosine 0.98 lies on one side of a
#: hyperplane with probability 1 - acos(0.98) / pi = 0.936, so it shares a bucket in
#: some table with probability 1 - (1 - 0.936 ** 16) ** 16 = 0.999.
TABLES = 16
PLANES = 16
SEED = 7
#: Members of a bucket that are compared as one block. A member of a bucket of m goes to
#: m / BLOCK comparisons, so a block is as large as a task's memory allows.
BLOCK = 4096
#: Members of a block whose cosines are computed at a time.
SLICE = 512
#: Rows that one task compares on average.
ROUTE = 20_000


def usable(vector: Column) -> Column:
    """Whether a vector has a direction: no null or non-finite component, and not all zero."""
    real = F.forall(
        vector,
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")),
    )
    return F.coalesce(vector.isNotNull() & real & F.exists(vector, lambda x: x != 0), F.lit(False))


def _hyperplanes(width: int, tables: int, planes: int) -> np.ndarray:
    return np.random.default_rng([SEED, width]).standard_normal((width, tables * planes))


def _coded(vectors: DataFrame, tables: int, planes: int) -> DataFrame:
    """(node, codes): the signs against the hyperplanes of each table as one integer."""

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = {}
        weights = 1 << np.arange(planes, dtype=np.int64)
        for batch in batches:
            column = batch.column(1)
            widths = pa.compute.list_value_length(column).to_numpy()
            codes = np.zeros((batch.num_rows, tables), np.int64)
            for width in np.unique(widths):
                rows = np.flatnonzero(widths == width)
                values = column.take(pa.array(rows)).flatten().to_numpy().reshape(len(rows), width)
                if width not in known:
                    known[width] = _hyperplanes(int(width), tables, planes)
                # A common factor changes no sign; without it no product overflows.
                values = values.astype(np.float64)
                values /= np.abs(values).max(axis=1, keepdims=True)
                signs = (values @ known[width] >= 0).reshape(len(rows), tables, planes)
                codes[rows] = signs @ weights
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(0, codes.size + 1, tables), pa.int32()), pa.array(codes.ravel())
            )
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], names=["node", "codes"])

    return vectors.select("node", "vector").mapInArrow(code, "node bigint, codes array<bigint>")


def compare_blocks(
    left: np.ndarray,
    right: np.ndarray | None,
    codes_left: np.ndarray,
    codes_right: np.ndarray | None,
    table: int,
    threshold: float,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(i, j, new): the pairs with enough cosine; ``new`` where no earlier table has the pair.

    Without ``right``, the pairs i < j within ``left``. Some rows of ``left`` are compared
    at a time, so that a large block's cosines need little memory.
    """
    other, codes_other = (left, codes_left) if right is None else (right, codes_right)
    lengths = np.sqrt((left * left).sum(axis=1))
    other_lengths = np.sqrt((other * other).sum(axis=1))
    found = []
    for at in range(0, len(left), SLICE):
        rows, skip = slice(at, at + SLICE), at if right is None else 0
        cosine = (left[rows] @ other[skip:].T) / (lengths[rows, None] * other_lengths[None, skip:])
        close = cosine >= threshold
        if right is None:
            close = np.triu(close, 1)
        i, j = np.nonzero(close)
        i, j = i + at, j + skip
        found.append((i, j, (codes_left[i, :table] == codes_other[j, :table]).any(axis=1)))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
    i, j, seen = map(np.concatenate, zip(*found))
    return i, j, ~seen


def _spanning(count: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For each of ``count`` nodes, the smallest node that pairs lead to; label spreading."""
    label = np.arange(count)
    while len(i):
        before = label.copy()
        np.minimum.at(label, i, label[j])
        np.minimum.at(label, j, label[i])
        label = label[label]
        if np.array_equal(before, label):
            break
    return label


def _links(members: DataFrame, threshold: float, routes: int) -> DataFrame:
    """(node, links, other): links counted once over all tables, and a node to be joined with.

    A bucket is cut into blocks; each pair of blocks is one comparison, and several
    comparisons share a task. Each gives at most one row per member, never the pairs.
    """

    def compare(table: pa.Table) -> pa.Table:
        frame = table.sort_by(
            [("width", "ascending"), ("label", "ascending"), ("number", "ascending"), ("code", "ascending"), ("low", "ascending"), ("high", "ascending")]
        ).combine_chunks()
        if not frame.num_rows:
            return table.select(["node"]).append_column("links", pa.array([], pa.int64())).append_column("other", pa.array([], pa.int64()))
        key = np.stack([frame[name].to_numpy() for name in ("width", "label", "number", "code", "low", "high")])
        edges = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1
        starts, stops = np.append(0, edges), np.append(edges, frame.num_rows)
        node, chunk, copies = (frame[n].to_numpy() for n in ("node", "chunk", "copies"))
        vectors, codes = frame["vector"].chunk(0), frame["codes"].chunk(0)
        out_node, out_links, out_other = [], [], []
        for a, b in zip(starts, stops):
            if b - a < 2:
                continue
            width, _, number, _, low, high = key[:, a]
            values = vectors.slice(a, b - a).flatten().to_numpy().reshape(b - a, width).astype(np.float64)
            values /= np.abs(values).max(axis=1, keepdims=True)
            own = codes.slice(a, b - a).flatten().to_numpy().reshape(b - a, -1)
            x = np.arange(b - a) if low == high else np.flatnonzero(chunk[a:b] == low)
            y = None if low == high else np.flatnonzero(chunk[a:b] == high)
            if y is not None and not (len(x) and len(y)):
                continue
            i, j, new = compare_blocks(
                values[x], None if y is None else values[y], own[x], None if y is None else own[y], number, threshold
            )
            if not len(i):
                continue
            i, j = x[i], (x if y is None else y)[j]
            weight = copies[a:b]
            links = np.bincount(i[new], weight[j[new]], b - a) + np.bincount(j[new], weight[i[new]], b - a)
            label = _spanning(b - a, i, j)
            touched = np.unique(np.concatenate((i, j)))
            out_node.append(node[a:b][touched])
            out_links.append(np.rint(links[touched]).astype(np.int64))
            out_other.append(node[a:b][label[touched]])
        joined = [np.concatenate(x) if x else np.array([], np.int64) for x in (out_node, out_links, out_other)]
        return pa.table(dict(zip(("node", "links", "other"), (pa.array(x, pa.int64()) for x in joined))))

    route = F.pmod(F.xxhash64("width", "label", "number", "code", "low", "high"), F.lit(routes))
    return (
        members.withColumn("route", route)
        .groupBy("route")
        .applyInArrow(compare, "node bigint, links bigint, other bigint")
    )


def near_vectors(
    embeddings: DataFrame,
    threshold: float = 0.98,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str = "label",
    tables: int = TABLES,
    planes: int = PLANES,
    block: int = BLOCK,
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every vector.

    Vectors link when their labels are equal and not null and their cosine, in
    double precision, reaches the threshold. Null, zero and non-finite vectors,
    those of different lengths and those with a null id link with nothing:
    ``n_links`` 0, ``component_id`` their own id. Equal vectors of a label are
    compared once and counted as often as they occur; rows that share an id are
    one node of the graph. An empty table gives no rows.

    1. Equal vectors are combined; each task sends one row for each.
    2. Signs against random hyperplanes file each vector in every table. Only ids
       and codes are shuffled to find the buckets with company.
    3. The vectors of those buckets meet in pairs of blocks; a link is counted in
       the first table that has it.
    """
    rows = embeddings.select(
        F.col(id_column).alias("vec_id"),
        F.col(vector_column).alias("vector"),
        F.col(label_column).alias("label"),
    )
    rows = _with_numbered_labels(rows)
    valid = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & usable(F.col("vector")))
    classes = stored(
        valid.groupBy("label", "vector").agg(F.min("vec_id").alias("least"), F.count("*").alias("copies"))
        .withColumn("node", F.monotonically_increasing_id())
    )
    codes = stored(_coded(classes, tables, planes))
    filed = classes.select("node", "label", F.size("vector").cast("bigint").alias("width")).join(codes, "node").select(
        "node", "label", "width", F.posexplode("codes").alias("number", "code")
    )
    key = ["width", "label", "number", "code"]
    shared = filed.groupBy(*key).agg(F.count("*").alias("members")).where("members > 1")
    chunks = F.ceil(F.col("members") / block).cast("bigint")
    placed = stored(filed.join(shared, key).withColumn("chunks", chunks))
    compared = placed.agg(F.sum("chunks")).first()[0] or 0
    routes = max(1, -(-compared // ROUTE))
    own = F.pmod(F.hash("node", "number"), F.col("chunks")).cast("bigint")
    blocks = placed.withColumn("chunk", own).withColumn(
        "partner", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("chunks") - 1))
    )
    members = (
        blocks.select(
            "node", *key[:1], "label", F.col("number").cast("bigint").alias("number"), "code", "chunk",
            F.least("chunk", "partner").alias("low"), F.greatest("chunk", "partner").alias("high"),
        )
        .join(classes.select("node", "vector", "copies"), "node")
        .join(codes, "node")
    )
    links = stored(_links(members, threshold, routes))
    return _answer(rows, valid, classes, links)


def _with_numbered_labels(rows: DataFrame) -> DataFrame:
    """The rows with whole numbers as labels; labels of other types are numbered as they are."""
    if isinstance(rows.schema["label"].dataType, IntegralType):
        return rows.withColumn("label", F.col("label").cast("bigint"))
    known = rows.where("label IS NOT NULL").select(F.col("label").alias("known")).distinct()
    known = stored(known.withColumn("number", F.monotonically_increasing_id()))
    joined = rows.join(known, rows["label"] == known["known"], "left")
    return joined.select("vec_id", "vector", F.col("number").alias("label"))


def _answer(rows: DataFrame, valid: DataFrame, classes: DataFrame, links: DataFrame) -> DataFrame:
    counted = links.groupBy("node").agg(F.sum("links").alias("links"))
    ids = classes.select("node", "label", "vector", "least", "copies")
    # Links between classes, and rows that share an id, join the same graph of ids.
    named = classes.select(F.col("node").alias("name"), F.col("least").alias("id"))
    ends = (
        links.join(named.withColumnsRenamed({"name": "node", "id": "a"}), "node")
        .join(named.withColumnsRenamed({"name": "other", "id": "b"}), "other")
        .select("a", "b")
    )
    classed = stored(
        valid.join(ids, ["label", "vector"]).join(counted, "node", "left").select(
            "vec_id", "least", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")
        )
    )
    joined = connected_components(ends.union(classed.select("vec_id", "least")))
    linked = (
        classed.join(joined, classed["vec_id"] == joined["node"], "left")
        .select("vec_id", "n_links", F.coalesce("component", "vec_id").alias("component_id"))
    )
    takes_part = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & usable(F.col("vector"))
    alone = rows.where(~takes_part).select(
        "vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return linked.unionByName(alone).withColumn(
        "kept", F.col("vec_id").eqNullSafe(F.col("component_id"))
    )
