"""Exact duplicates: local combining, then salted groups, then the winners of all salts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.storage import fresh, stored

SALTS = 16


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(F.encode(text, "UTF-8"), 256))


def duplicate_classes(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    salts: int = SALTS,
    digest: Callable[[Column], Column] = sha256,
) -> DataFrame:
    """(digest, variants, keep_id, group_size) of each digest that more than one row has.

    Every task first combines its own equal texts. What is left meets by digest
    and salt, the number of its task; then the winners of all salts of a digest
    meet. Every stage groups by the whole text besides the digest, so
    ``variants`` counts the different texts of a digest exactly. A group of
    copies sends at most one row per task and then one per salt.
    """
    rows = documents.select(
        F.col(id_column).alias("id"),
        F.coalesce(F.col(text_column), F.lit("")).alias("body"),
        F.pmod(F.spark_partition_id(), F.lit(salts)).alias("salt"),
    ).withColumn("digest", digest(F.col("body")))
    salted = rows.groupBy("digest", "salt", "body").agg(
        F.max("id").alias("keep_id"), F.count("*").alias("members")
    )
    combined = (
        salted.repartition("digest")
        .groupBy("digest", "body")
        .agg(F.max("keep_id").alias("keep_id"), F.sum("members").alias("members"))
    )
    return (
        combined.groupBy("digest")
        .agg(
            F.count("*").alias("variants"),
            F.max("keep_id").alias("keep_id"),
            F.sum("members").alias("group_size"),
        )
        .where("group_size > 1")
    )


def with_classes(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    salts: int = SALTS,
    digest: Callable[[Column], Column] = sha256,
) -> tuple[DataFrame, dict[str, str]]:
    """All rows and columns, with the class of each row, and the names of the new columns.

    The new columns are ``digest``, ``keep_id`` and ``group_size``, renamed where
    the documents already have such names. Rows of a digest that only one text
    has find their class by the digest. If different texts share a digest, their
    rows are grouped again by the text itself.
    """
    d, k, n = fresh(documents, "digest", "keep_id", "group_size")
    classes = stored(duplicate_classes(documents, id_column, text_column, salts, digest))
    single = classes.where("variants = 1").select(
        F.col("digest").alias(d), F.col("keep_id").alias(k), F.col("group_size").alias(n)
    )
    body = F.coalesce(F.col(text_column), F.lit(""))
    rows = documents.withColumn(d, digest(body))
    shared = classes.where("variants > 1").select(F.col("digest").alias(d))
    marked = rows
    if not shared.isEmpty():
        marked = rows.join(shared, d, "left_anti")
    marked = marked.join(single, d, "left").withColumns(
        {k: F.coalesce(k, F.col(id_column)), n: F.coalesce(n, F.lit(1).cast("long"))}
    )
    if not shared.isEmpty():
        (t,) = fresh(rows, "body")
        collided = rows.join(shared, d, "left_semi").withColumn(t, body)
        exact = collided.groupBy(t).agg(
            F.max(id_column).alias(k), F.count("*").alias(n)
        )
        marked = marked.unionByName(collided.join(exact, t).drop(t))
    return marked, {"digest": d, "keep_id": k, "group_size": n}


def exact_duplicates(
    documents: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options
) -> DataFrame:
    """One row per document: which document of its group of equal texts stays.

    Texts are equal when identical; a null text counts as empty. The largest id
    stays. Rows that repeat both id and text are all marked as kept, since they
    name the same document; a null id loses against any other, and a group with
    null ids only has a null ``keep_id`` and keeps all its rows. An empty table
    gives an empty result. Other columns are not read.
    """
    narrow = documents.select(
        F.col(id_column).alias("doc_id"),
        F.col(text_column).alias("text"),
        F.lower(F.hex(sha256(F.coalesce(F.col(text_column), F.lit(""))))).alias("text_sha256"),
    )
    marked, names = with_classes(narrow, **options)
    return marked.select(
        "doc_id",
        F.col(names["keep_id"]).alias("keep_id"),
        F.col(names["group_size"]).alias("group_size"),
        F.col("doc_id").eqNullSafe(F.col(names["keep_id"])).alias("kept"),
        "text_sha256",
    )


def keep_one(
    documents: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options
) -> DataFrame:
    """The documents without all copies but the one with the largest id, columns unchanged.

    Rows that repeat the kept id and text are reduced to one of them, a null text counting
    as empty: the one whose columns, written as JSON, come first.
    """
    marked, names = with_classes(documents, id_column, text_column, **options)
    kept = marked.where(F.col(id_column).eqNullSafe(F.col(names["keep_id"])))
    columns = [F.col("`" + column.replace("`", "``") + "`") for column in documents.columns]
    single = kept.where(F.col(names["group_size"]) == 1).select(*columns)
    several = kept.where(F.col(names["group_size"]) > 1)
    body = F.coalesce(F.col(text_column), F.lit("")).alias("body")
    whole = F.struct(*columns)
    one = several.groupBy(F.col(names["digest"]).alias("digest"), body).agg(
        F.min_by(whole, F.to_json(whole, {"ignoreNullFields": "false"})).alias("row")
    )
    return single.unionByName(one.select("row.*"))
