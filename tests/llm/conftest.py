from __future__ import annotations

import pytest
from llm_support import ODD_DOCUMENTS, PATH
from tokenizers import Tokenizer


@pytest.fixture(scope="session")
def tokenizer():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="session")
def odd(spark):
    """Odd documents with more columns, whose names operators also use."""
    from pyspark.sql import functions as F

    frame = spark.createDataFrame(ODD_DOCUMENTS, "doc_id bigint, text string")
    names = ("digest", "keep_id", "group_size", "fp", "component_id", "key", "spans", "kept", "score", "statistics")
    return frame.withColumns({name: F.lit(name) for name in names})


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], "doc_id bigint, text string")
