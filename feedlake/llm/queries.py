"""The operators applied to the given tables, each with its check in SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from feedlake.llm import (
    align, ann, bpe, conversations, fingerprints, licenses, neardup, packing, pii, quality, rules, toxicity, urls,
)
from feedlake.llm.common import held_out, table
from feedlake.llm.sql import NEAR_COPIES, RULES, URLS
from feedlake.session import prepare

BYTE_BPE = "byte_bpe_50k.tiktoken"
BYTE_LEVEL, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"
WORD_BPE = corpus_pipeline.TOKENIZER
URL_RULES = (
    urls.Rule("com", "/", urls.ALLOW),
    urls.Rule("example.com", "/en/", urls.BLOCK),
    urls.Rule("www.example.com", "/en/", urls.ALLOW),
    urls.Rule("net", "/es/", urls.BLOCK),
    urls.Rule("net", "/fr/", urls.BLOCK),
)
GOOD_FROM, TOXIC_FROM = 0.3, 0.5


class Query(NamedTuple):
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


def content(name: str) -> bytes:
    """A public vocabulary file; read once on the driver and sent with the tasks."""
    with open(public_tokenizers.path(name), "rb") as f:
        return f.read()


def url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge_urls(table(spark, sf_dir, "pages"), urls.rule_table(spark, URL_RULES))


def curve_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    packed = packing.pack_documents(docs, content(WORD_BPE).decode())
    return packed.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return ann.nearest(vectors, vectors.filter("vec_id % 100 = 0"))


def byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = content(BYTE_BPE)
    encoded = bpe.encode_documents(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)
    return bpe.decode_documents(encoded, ranks).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"),
    )


def toxicity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(*toxicity.training_sample(docs, table(spark, sf_dir, "labels"), "toxic"))
    return toxicity.score_toxicity(docs, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"),
    )


def license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    sample = toxicity.training_sample(
        docs, table(spark, sf_dir, "labels"), "quality",
        sample_rows=quality.SAMPLE_ROWS, sample_chars=quality.SAMPLE_CHARS,
    )
    return quality.score_quality(docs, quality.fit(*sample)).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= GOOD_FROM).cast("int").alias("predicted"),
    )


def rule_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Which of several rules is met first depends on measured times.
    return rules.judge_quality(table(spark, sf_dir, "documents")).drop("failed_rule")


def pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonymize(
        table(spark, sf_dir, "documents").select("doc_id", "text"), corpus_pipeline.PII_KEY, count_col="n_replaced"
    )


def near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), words=2)


def tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = F.col("groups")
    aligned = align.align_documents(
        table(spark, sf_dir, "documents"), content(BYTE_LEVEL).decode(), content(PIECES),
        shown=lambda g: F.when(g != "", F.sha2(g, 256)).otherwise(""),
    )
    return aligned.withColumn("groups_sha256", groups).drop("groups")


def conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair_report(conversations.damaged(table(spark, sf_dir, "conversations")))


def document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    printed = fingerprints.fingerprint_documents(table(spark, sf_dir, "documents"))
    return printed.withColumn("edited_sha256", F.sha2("edited_text", 256)).drop("edited_text")


def _prepared(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: run(prepare(spark), sf_dir)


QUERIES = {
    name: Query(_prepared(run), sql)
    for name, run, sql in (
        ("op1_url_filter", url_filter, URLS),
        ("op2_curve_packing", curve_packing, None),
        ("op3_multi_index", multi_index, None),
        ("op4_byte_bpe", byte_bpe, None),
        ("op5_toxicity", toxicity_scores, None),
        ("op6_license_scan", license_scan, None),
        ("op7_line_quality", line_quality, None),
        ("op8_rule_cascade", rule_cascade, RULES),
        ("op9_pseudonyms", pseudonyms, None),
        ("op10_near_copies", near_copies, NEAR_COPIES),
        ("op11_tokenizer_alignment", tokenizer_alignment, None),
        ("op12_conversation_repair", conversation_repair, None),
        ("op13_document_fingerprints", document_fingerprints, None),
        ("pipeline", corpus_pipeline.run, corpus_pipeline.ORACLE_SQL),
    )
}
