from __future__ import annotations

import public_tokenizers
import pytest

from tests.llm.cases import DOCS, DOC_SCHEMA


@pytest.fixture(scope="session")
def docs(spark):
    """Awkward documents: nulls, empty and long texts, repeated rows, columns with clashing names."""
    return spark.createDataFrame(DOCS, DOC_SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], DOC_SCHEMA)


@pytest.fixture(scope="session")
def tokenizer():
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        return f.read()
