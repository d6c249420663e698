"""One query per operator over its whole table; the digest columns are taken from its rows."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm.bpe_codec import digests
from tallyloom.llm.byte_dedup import without_repeated_bytes
from tallyloom.llm.collocations import collocations
from tallyloom.llm.conversation_trie import conversation_trie
from tallyloom.llm.embedding_dedup import near_vectors
from tallyloom.llm.exact_dedup import exact_duplicates
from tallyloom.llm.packing import packed
from tallyloom.llm.quality import quality_scores
from tallyloom.llm.simhash import simhash_groups
from tallyloom.llm.substring_dedup import without_repeats
from tallyloom.llm.token_count import token_counts
from tallyloom.llm.toxicity import toxicity_scores
from tallyloom.llm.url_filter import ALLOW, BLOCK, UrlRule, given_verdicts, judged_urls

VOCABULARY = "byte_bpe_50k.json"
URL_RULES = [
    UrlRule("org", "/", ALLOW),
    UrlRule("example.org", "/es/", BLOCK),
    UrlRule("example.org", "/en/1", BLOCK),
    UrlRule("com", "/fr/", ALLOW),
    UrlRule("com", "/de/", BLOCK),
]


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_duplicates(_table(spark, folder, "documents"))


def op2_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_vectors(_table(spark, folder, "embeddings"), threshold=0.98)


def op3_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash_groups(_table(spark, folder, "documents"), shingle=3, max_distance=3)


def op4_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return judged_urls(_table(spark, folder, "pages"), URL_RULES)


def op5_token_count(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts(_table(spark, folder, "documents"), public_tokenizers.path(VOCABULARY))


def op6_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality_scores(
        _table(spark, folder, "documents"), _table(spark, folder, "labels"), threshold=0.3
    )


def op7_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packed(
        _table(spark, folder, "documents"), public_tokenizers.path(VOCABULARY), capacity=2048, end_id=1
    )


def op8_bpe_codec(spark: SparkSession, folder: str) -> DataFrame:
    return digests(_table(spark, folder, "documents"), public_tokenizers.path(VOCABULARY))


def op9_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    marked, names = without_repeats(_table(spark, folder, "documents"), window=20)
    return marked.select(
        "doc_id",
        F.col(names["n_words"]).alias("n_words"),
        F.col(names["n_removed"]).alias("n_removed"),
        F.sha2(F.encode(names["kept"], "UTF-8"), 256).alias("kept_sha256"),
    )


def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity_scores(
        _table(spark, folder, "documents"), _table(spark, folder, "labels"), threshold=0.5
    )


def op11_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations(
        _table(spark, folder, "documents"), max_words=3, min_count=10, inside_percent=50, top=2000
    )


def op12_conversation_trie(spark: SparkSession, folder: str) -> DataFrame:
    return conversation_trie(_table(spark, folder, "conversations"), group=5, spread=9)


def op13_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    marked, names = without_repeated_bytes(_table(spark, folder, "documents"), width=200)
    return marked.select(
        "doc_id",
        F.col(names["n_bytes"]).alias("n_bytes"),
        F.col(names["n_removed"]).alias("n_removed"),
        F.col(names["n_spans"]).alias("n_spans"),
        F.sha2(names["kept"], 256).alias("kept_sha256"),
    )


def given_url_rules(spark: SparkSession, folder: str) -> DataFrame:
    """What of op4_url_filter SQL can express: hosts, paths, and the rules given."""
    return given_verdicts(_table(spark, folder, "pages"), URL_RULES).drop("url")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_embedding_dedup": op2_embedding_dedup,
    "op3_simhash": op3_simhash,
    "op4_url_filter": op4_url_filter,
    "given_url_rules": given_url_rules,
    "op5_token_count": op5_token_count,
    "op6_quality": op6_quality,
    "op7_packing": op7_packing,
    "op8_bpe_codec": op8_bpe_codec,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_toxicity": op10_toxicity,
    "op11_collocations": op11_collocations,
    "op12_conversation_trie": op12_conversation_trie,
    "op13_suffix_dedup": op13_suffix_dedup,
}
