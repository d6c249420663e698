"""The document pipeline: each stage reads what the one before it has written."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tallyloom.llm.exact_dedup import keep_one
from tallyloom.llm.packing import packed
from tallyloom.llm.quality import keep_good
from tallyloom.llm.simhash import keep_one_of_group
from tallyloom.llm.storage import shared_folder
from tallyloom.llm.substring_dedup import remove_repeats

#: Words of a shingle and differing bits of near-duplicates, as the operator's query has them.
NEAR_SHINGLE, NEAR_BITS = 3, 3


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble scores below 0.3 go."""
    return keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), threshold=0.3)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the largest id stays."""
    return keep_one(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates, the document with the smallest id stays."""
    return keep_one_of_group(docs, shingle=NEAR_SHINGLE, max_distance=NEAR_BITS)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words covered by a passage of 20 words that an earlier document has go."""
    return remove_repeats(docs, window=20)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, placed in sequences of 2048 tokens."""
    return packed(docs, public_tokenizers.path("byte_bpe_50k.json"), capacity=2048, end_id=1)


STAGES = [
    ("quality", quality),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("packing", packing),
]

#: A learned model, fingerprints and tokens can't be put in SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the documents; each result is written to the shared folder and reread.

    A stage's files go when the next one's are complete; those of the last stay.
    """
    folder = f"{shared_folder(spark)}/corpus-{uuid.uuid4().hex}"
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            done = spark._jvm.org.apache.hadoop.fs.Path(before)
            done.getFileSystem(spark._jsc.hadoopConfiguration()).delete(done, True)
        before = path
    return docs
