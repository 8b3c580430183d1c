"""Quality rules against plain Python."""

from __future__ import annotations

import collections
import re

from pyspark.sql import functions as F

from feedlake.llm import rules
from tests.llm.cases import DOC_SCHEMA, DOCS, prose

MORE = [
    "a b c a b c", "a b c d a b c", "x x x x x x", "l1 a\nl1 a\n\n\n  \nl1 a\n l1 a", "#a *b $c %d &e |f <g >h",
    ("junk words *** " * 40), (prose(5, 30) + "\n") * 4, prose(6, 200).upper(), "\n".join(["same line here"] * 60),
]


def statistics(text):
    text = text or ""
    words = [w for w in re.split("[\x20\x09-\x0d]+", text) if w]
    grams = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    count = collections.Counter(grams)
    covered = {i + d for i, g in enumerate(grams) if count[g] > 1 for d in range(3)}
    lines = [x for x in text.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    return (
        len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)),
        len(covered), len(words) < 50 or 100 * len(covered) > 50 * len(words), len(lines),
        sum(bool(re.match("^[^a-z]*[A-Z][^a-z]*[A-Z][^a-z]*$", w)) for w in words),
    )


def kept(text):
    n, _, symbols, dup, _, failed, lines, capitals = statistics(text)
    return not failed and not (symbols * 4 > n or capitals * 100 > n * 60 or dup * 100 > lines * 40)


def frame(spark):
    rows = DOCS + [(100 + i, t, *DOCS[0][2:]) for i, t in enumerate(MORE)]
    return rows, spark.createDataFrame(rows, DOC_SCHEMA)


def test_statistics_and_verdict(spark):
    rows, df = frame(spark)
    got = rules.judge_quality(df).drop("failed_rule").collect()
    wanted = [(r[0], *statistics(r[1])[:6], kept(r[1])) for r in rows]
    assert sorted(map(tuple, got), key=str) == sorted(wanted, key=str)


def test_filter_keeps_rows_and_columns(spark):
    rows, df = frame(spark)
    out = rules.filter_quality(df)
    assert out.schema == df.schema
    assert sorted(map(tuple, out.collect()), key=str) == sorted([r for r in rows if kept(r[1])], key=str)


def test_order_changes_cost_only(spark):
    rows, df = frame(spark)
    everything = rules.BASE_RULES + rules.RULES
    text = F.col("text")
    one = df.filter(rules.first_failed(text, everything).isNull()).count()
    assert df.filter(rules.first_failed(text, everything[::-1]).isNull()).count() == one
    assert sorted(r.name for r in rules.order_rules(df, everything)) == sorted(r.name for r in everything)


def test_empty_table(spark, none):
    assert rules.judge_quality(none).count() == 0
    assert rules.filter_quality(none).count() == 0


def test_plan_is_native(spark, docs):
    plan = rules.judge_quality(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
