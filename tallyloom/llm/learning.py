"""Splits and bounded samples of labelled documents, shared by the classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.storage import stored

#: Labelled rows that a classifier is fitted on, about, at most.
MAX_LABELLED = 20_000
_SPACE = 1_000_000


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from all training: crc32 of its id as text divides by 5."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def labelled_sample(
    documents: DataFrame,
    labels: DataFrame,
    label: str,
    max_labelled: int = MAX_LABELLED,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """(text, label) of a sample of the labelled documents that are not held out.

    A labelled document takes part once, however often its row is repeated; of several
    texts with its id, the smallest. If there are more than ``max_labelled``, a row takes part if a hash of its id lies
    below the share wanted. The sample's ids are broadcast, since ``max_labelled``
    bounds them; documents are not shuffled. Null labels and ids are left out.
    """
    usable = labels.where(
        F.col(label).isNotNull() & F.col(id_column).isNotNull() & ~held_out(F.col(id_column))
    ).select(F.col(id_column).alias("labelled_id"), F.col(label).cast("int").alias("label"))
    share = min(1.0, max_labelled / max(1, usable.count()))
    chosen = usable.where(
        F.pmod(F.xxhash64("labelled_id"), F.lit(_SPACE)) < int(share * _SPACE)
    ).distinct()
    return stored(
        documents.select(F.col(id_column).alias("document_id"), F.col(text_column).alias("text"))
        .join(F.broadcast(chosen), F.col("document_id") == F.col("labelled_id"))
        .groupBy("labelled_id", "label")
        .agg(F.min("text").alias("text"))
        .select("text", "label")
    )


def constant_score(sample: DataFrame) -> float | None:
    """The smoothed share of label 1 where the sample lacks one of the labels, else None."""
    ones, rows = sample.agg(F.sum("label"), F.count("*")).first()
    if rows and 0 < ones < rows:
        return None
    return ((ones or 0) + 1) / (rows + 2)
