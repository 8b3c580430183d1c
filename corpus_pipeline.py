"""From documents to packed training sequences.

Documents that the quality rules or the toxicity classifier reject go, of each group of
near copies one stays, personal data is replaced by pseudonyms, and what is left is
packed into sequences. Each stage is written and read again before the next.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.llm import neardup, packing, pii, rules, toxicity
from feedlake.llm.common import table
from feedlake.session import materialize, prepare

TOKENIZER = "word_bpe_49k.json"
PII_KEY = "feedlake-demonstration-key"  # a real run passes a secret of its own
ORACLE_SQL = None  # training, hashing and tokenizing are beyond SQL


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that no rule rejects."""
    return rules.filter_quality(docs)


def toxic_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that are not scored as toxic, by a model learnt from the labelled rows."""
    sample = toxicity.training_sample(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), "toxic"
    )
    return toxicity.drop_toxic(docs, toxicity.fit(*sample))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id."""
    return neardup.drop_near_duplicates(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with pseudonyms; n_chars, where there is one, follows the text."""
    masked = pii.pseudonymize(docs, PII_KEY)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        masked = masked.withColumn("n_chars", F.length("text").cast(kind))
    return masked


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, with their token ids, and where they lie."""
    with open(public_tokenizers.path(TOKENIZER), encoding="utf-8") as f:
        return packing.pack_documents(docs, f.read())


STAGES = [
    ("quality rules", quality_rules),
    ("toxicity", toxic_texts),
    ("near copies", near_copies),
    ("personal data", personal_data),
    ("packing", sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; an empty table gives no sequences."""
    docs = table(prepare(spark), sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
