"""Quality rules as a short-circuit cascade.

Each rule rejects documents by an expression on the text. Cost and selectivity
of the rules are estimated on a sample; the rules then run in the order of
rejections per cost, and a document that one rejects meets no further rule.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlake.llm.common import let, words_of

SYMBOLS = "#*$%&|<>"
SAMPLE_ROWS = 2_000  # rows on which cost and selectivity are estimated
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50


class Rule(NamedTuple):
    name: str
    rejects: Callable[[Column], Column]  # of a text, to a boolean that is never null


def _text(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def n_symbols(text: Column) -> Column:
    t = _text(text)
    return (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("long")


def n_dup_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(_text(text), "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    return let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long"))


def _repeated(words: Column) -> Column:
    """Words in windows of three that the text holds twice or more.

    Windows are hashed and sorted with their places; equal neighbours mark the
    repeated ones. A window covers three words, less what the next one covers.
    Texts without a repeated window, most of them, are done after one hash set.
    """

    def places(grams: Column) -> Column:
        ordered = F.array_sort(F.transform(grams, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return let(
            ordered,
            lambda s: F.array_sort(
                F.filter(
                    F.transform(
                        s,
                        lambda x, i: F.when(
                            F.coalesce(x["h"] == F.get(s, i - 1)["h"], F.lit(False))
                            | F.coalesce(x["h"] == F.get(s, i + 1)["h"], F.lit(False)),
                            x["i"],
                        ),
                    ),
                    lambda p: p.isNotNull(),
                )
            ),
        )

    def covered(grams: Column) -> Column:
        spans = let(
            places(grams),
            lambda p: F.transform(
                p, lambda x, i: F.least(F.lit(3), F.coalesce(F.get(p, i + 1) - x, F.lit(3)))
            ),
        )
        total = F.aggregate(spans, F.lit(0).cast("long"), lambda a, x: a + x)
        return F.when(F.size(F.array_distinct(grams)) == F.size(grams), F.lit(0).cast("long")).otherwise(total)

    grams = F.transform(
        F.slice(words, F.lit(1), F.greatest(F.size(words) - 2, F.lit(0))),
        lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)),
    )
    return let(grams, covered)


def base_statistics(text: Column) -> Column:
    """Struct of n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words; zeros for null."""
    return let(
        words_of(text),
        lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.aggregate(w, F.lit(0).cast("long"), lambda a, x: a + F.length(x)).alias("word_chars"),
            n_symbols(text).alias("n_symbols"),
            n_dup_lines(text).alias("n_dup_lines"),
            _repeated(w).alias("n_repeat_words"),
        ),
    )


def base_failed(stats: Column) -> Column:
    return (stats["n_words"] < MIN_WORDS) | (
        100 * stats["n_repeat_words"] > MAX_REPEAT_PERCENT * stats["n_words"]
    )


def _word_rule(test: Callable[[Column], Column]) -> Callable[[Column], Column]:
    return lambda text: let(words_of(text), test)


def _share(part: Column, whole: Column, percent: int) -> Column:
    """`part` is more than `percent` of `whole`, in whole numbers."""
    return (part.cast("long") * 100) > (whole.cast("long") * percent)


def _capital_words(w: Column) -> Column:
    """Words of two letters or more without a small letter of ASCII."""
    return F.size(F.filter(w, lambda x: x.rlike("^[^a-z]*[A-Z][^a-z]*[A-Z][^a-z]*$")))


BASE_RULES = (
    Rule("few_words", _word_rule(lambda w: F.size(w) < MIN_WORDS)),
    Rule(
        "repeated_words",
        _word_rule(lambda w: _share(_repeated(w), F.size(w), MAX_REPEAT_PERCENT)),
    ),
)
# Thresholds far beyond what prose reaches, so that clean documents stay.
RULES = (
    Rule("symbols", lambda t: n_symbols(t) * 4 > F.size(words_of(t))),
    Rule("capitals", _word_rule(lambda w: _share(_capital_words(w), F.size(w), 60))),
    Rule(
        "repeated_lines",
        lambda t: _share(
            n_dup_lines(t),
            F.size(F.filter(F.split(_text(t), "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))),
            40,
        ),
    ),
)


def order_rules(
    docs: DataFrame, rules: Sequence[Rule], text_col: str = "text", sample_rows: int = SAMPLE_ROWS
) -> list[Rule]:
    """The rules, those with most rejections per second on a sample first.

    The order changes the cost of a cascade only, never its verdict. Ties, and
    an empty sample, keep the given order. The sample is a few rows as they lie.
    """
    spark = docs.sparkSession
    texts = [r[0] for r in docs.select(text_col).limit(sample_rows).toLocalIterator()]
    if not texts:
        return list(rules)
    sample = spark.createDataFrame([(t,) for t in texts], "_t string").coalesce(1)
    rated = []
    for place, rule in enumerate(rules):
        began = time.perf_counter()
        rejected = sample.agg(F.sum(rule.rejects(F.col("_t")).cast("int"))).first()[0]
        rated.append((-(rejected or 0) / (time.perf_counter() - began), place, rule))
    return [rule for _, _, rule in sorted(rated, key=lambda x: x[:2])]


def first_failed(text: Column, rules: Sequence[Rule]) -> Column:
    """The name of the first rule that rejects a text, null if none does."""
    chain = F.lit(None).cast("string")
    for rule in reversed(rules):
        chain = F.when(rule.rejects(text), F.lit(rule.name)).otherwise(chain)
    return chain


def filter_quality(
    docs: DataFrame, rules: Sequence[Rule] = BASE_RULES + RULES, text_col: str = "text",
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """The rows that no rule rejects, with all their columns.

    A null text counts as an empty one. Rows are judged one by one: repeated
    rows stay or go together. An empty table stays empty.
    """
    ordered = order_rules(docs, rules, text_col, sample_rows)
    return docs.filter(first_failed(F.col(f"`{text_col}`"), ordered).isNull())


def judge_quality(
    docs: DataFrame, rules: Sequence[Rule] = RULES, id_col: str = "doc_id", text_col: str = "text",
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """Statistics and verdict for every row: (id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, kept, failed_rule).

    `kept` is false where the base rules fail, else where a rule of the cascade
    rejects the text; `failed_rule` names it. A null text has no words.
    """
    ordered = order_rules(docs, rules, text_col, sample_rows)
    text = F.col(f"`{text_col}`")
    # One struct, so that the statistics are computed once per row.
    judged = docs.select(
        F.col(f"`{id_col}`").alias(id_col),
        F.explode(
            F.array(
                let(
                    base_statistics(text),
                    lambda s: F.struct(
                        s.alias("s"),
                        base_failed(s).alias("b"),
                        F.when(~base_failed(s), first_failed(text, ordered)).alias("f"),
                    ),
                )
            )
        ).alias("_j"),
    )
    return judged.select(
        id_col, "_j.s.*",
        F.col("_j.b").alias("base_failed"),
        (~F.col("_j.b") & F.col("_j.f").isNull()).alias("kept"),
        F.col("_j.f").alias("failed_rule"),
    )
