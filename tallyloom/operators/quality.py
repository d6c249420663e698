"""Deduplication, completion and audits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType

from tallyloom.operators.columns import any_null, quoted

# What a missing value is stored as.
MISSING_TEXT = "Unknown"
MISSING_NUMBER = 0


def dedupe(frame: DataFrame, key: Sequence[str], prefer: Sequence[str] = ()) -> DataFrame:
    """One row per key: the smallest of its rows, nulls last.

    Rows are compared by the ``prefer`` columns first and then by all others in
    table order, so the survivor never depends on partitioning. The choice is a
    minimum over whole rows: each task reduces its own rows to one per key
    before the shuffle, so a key that holds a third of the table sends at most
    one row per task.
    """
    others = [name for name in frame.columns if name not in key]
    ranked = [*prefer, *(name for name in others if name not in prefer)]
    if not ranked:
        return frame.distinct()
    fields = []
    for position, name in enumerate(ranked):
        fields.append(quoted(name).isNull().alias(f"n{position}"))
        fields.append(quoted(name).alias(f"v{position}"))
    kept = frame.groupBy(*(quoted(name) for name in key)).agg(F.min(F.struct(*fields)).alias("_kept"))
    place = {name: F.col(f"_kept.v{position}").alias(name) for position, name in enumerate(ranked)}
    return kept.select(*(quoted(name) if name in key else place[name] for name in frame.columns))


def fill_missing(
    frame: DataFrame, key: Sequence[str], keep_null: Sequence[str] = ()
) -> DataFrame:
    """Complete text and numbers outside the key; dates and booleans stay as they are."""
    fills: dict[str, str | int] = {}
    for item in frame.schema:
        if item.name in key or item.name in keep_null:
            continue
        if isinstance(item.dataType, StringType):
            fills[item.name] = MISSING_TEXT
        elif isinstance(item.dataType, NumericType):
            fills[item.name] = MISSING_NUMBER
    return frame.fillna(fills) if fills else frame


def audit(frame: DataFrame, critical: str | Sequence[str] = ()) -> DataFrame:
    """One row: ``row_count`` and ``null_rows``, the rows with any critical null."""
    return frame.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(any_null(critical)).alias("null_rows"),
    )


def duplicate_keys(frame: DataFrame, key: Sequence[str]) -> DataFrame:
    """Every key that occurs more than once, with its number of ``copies``."""
    return (
        frame.groupBy(*(quoted(name) for name in key))
        .agg(F.count(F.lit(1)).alias("copies"))
        .where("copies > 1")
    )


def duplicate_summary(frame: DataFrame, key: Sequence[str]) -> DataFrame:
    """One row: rows read, keys kept, and rows that deduplication drops."""
    per_key = frame.groupBy(*(quoted(name) for name in key)).agg(F.count(F.lit(1)).alias("copies"))
    return per_key.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("row_count"),
        F.count(F.lit(1)).alias("key_count"),
        F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("dropped"),
    )


def join_growth(
    frame: DataFrame, dimension: DataFrame, on: str | Sequence[str]
) -> DataFrame:
    """One row: fact rows before and after a left join, without running the join.

    Both sides are first reduced to one count per key, so a key that is hot on
    both sides costs one multiplication, not the product of its rows.
    """
    keys = [on] if isinstance(on, str) else list(on)
    facts = frame.groupBy(*map(quoted, keys)).agg(F.count(F.lit(1)).alias("facts"))
    for key in keys:
        dimension = dimension.where(quoted(key).isNotNull())
    matches = dimension.groupBy(*map(quoted, keys)).agg(F.count(F.lit(1)).alias("matches"))
    joined = facts.join(matches, keys, "left")
    after = F.col("facts") * F.coalesce("matches", F.lit(1))
    return joined.agg(
        F.coalesce(F.sum("facts"), F.lit(0)).alias("rows_before"),
        F.coalesce(F.sum(after), F.lit(0)).alias("rows_after"),
        F.coalesce(F.sum(F.when(F.col("matches").isNull(), F.col("facts"))), F.lit(0)).alias(
            "rows_unmatched"
        ),
    )
