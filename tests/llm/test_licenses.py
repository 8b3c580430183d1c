"""License scans against a plain search for phrases, and for changed templates."""

from __future__ import annotations

import random
import re

import pytest

from feedlake.llm import licenses
from tests.llm.cases import DOC_SCHEMA, DOCS

PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
MORE = [
    "CC-BY cc by ccby, cc\nBY", "GNU General, Public; License! general public licenses",
    "all all rights reserved rights reserved all rights  reserved", "cc by cc by cc", "by cc",
    "Released under the MIT License.", "Licensed under the Apache License, Version 2.0.",
    "filler words released under the new MIT license and more", "apache license",
    "all rights are reserved", "İcc by ıcc by cc by", "cc é by", "general public license " * 500,
]


def words(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def base(text):
    w = words(text)
    hits = [
        (i, label) for p, label in PHRASES.items() for i in range(len(w)) if w[i:i + len(p.split())] == p.split()
    ]
    starts = [i for i, _ in hits]
    return (
        len(w), len(hits), min(starts, default=None), max(starts, default=None),
        ",".join(sorted({x for _, x in hits})),
    )


def scanned(spark, texts):
    rows = DOCS + [(100 + i, t, *DOCS[0][2:]) for i, t in enumerate(texts)]
    return rows, licenses.scan_licenses(spark.createDataFrame(rows, DOC_SCHEMA).repartition(3))


def test_base_phrases(spark):
    rows, df = scanned(spark, MORE)
    got = [tuple(r)[:6] for r in df.collect()]
    assert sorted(got, key=str) == sorted([(r[0], *base(r[1])) for r in rows], key=str)


def test_templates_in_part(spark):
    _, df = scanned(spark, MORE)
    found = {r["doc_id"]: (r["labels"], r["score"]) for r in df.filter("doc_id >= 100").collect()}
    assert found[105] == ("mit", 1.0) and found[106] == ("apache", 1.0)
    assert found[107][0] == "mit" and 0.6 <= found[107][1] < 1
    assert found[108] == ("", 0.0) and found[109] == ("", 0.0)
    assert found[101] == ("gpl", 1.0)
    assert all(0 <= r["score"] <= 1 and set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(","))
               for r in df.collect())


def parts(text, template):
    """The largest share of a template's word pairs in any span of its length with room for drift, the long way."""
    w, t = words(text), template.phrase.split(" ")
    pairs = list(zip(t, t[1:]))
    votes = [(i, k) for i, pair in enumerate(zip(w, w[1:])) for k, other in enumerate(pairs) if pair == other]
    best = 0
    for i, k in votes:
        near = {
            q for p, q in votes
            if i <= p < i + len(pairs) + licenses.DRIFT and abs((p - q) - (i - k)) <= licenses.DRIFT
        }
        best = max(best, len(near) / len(pairs))
    return best if best >= licenses.MIN_COVERAGE else 0


def test_every_template_is_found_among_stutters(spark):
    rnd = random.Random(7)
    texts = [
        "under the under the under the licensed under the apache license version 2 0",
        "of the gnu of the gnu of the gnu you can redistribute it and or modify it under the terms of the gnu of the gnu of the gnu",
        "\u212a cc by", "by the cc by the cc BY",
    ]
    for t in licenses.TEMPLATES:
        own = t.phrase.split(" ")
        for _ in range(12):
            body = own[:]
            for _ in range(rnd.randint(0, 3)):
                body.insert(rnd.randrange(len(body)), rnd.choice([*own, "other"]))
            if rnd.random() < 0.4 and len(body) > 3:
                del body[rnd.randrange(len(body))]
            starts = [rnd.randrange(len(own)) for _ in range(rnd.randint(0, 6))]
            stutter = [x for k in starts for x in own[k:k + 2]]
            texts.append(" ".join([*stutter, *body, *reversed(stutter)]))
    rows, df = scanned(spark, texts)
    got = {r["doc_id"]: (r["labels"], round(r["score"], 9)) for r in df.collect()}
    assert got[100][0] == "apache" and got[101][0] == "gpl"
    for doc_id, text, *_ in rows:
        if doc_id is None or doc_id < 100:
            continue
        shares = {t: parts(text, t) for t in licenses.TEMPLATES if not t.exact}
        labels = {t.label for t, share in shares.items() if share} | set(filter(None, base(text)[4].split(",")))
        score = 1.0 if base(text)[1] else max(shares.values())
        assert got[doc_id] == (",".join(sorted(labels)), round(score, 9)), text


def test_empty_table_and_short_templates(spark, none):
    assert licenses.scan_licenses(none).count() == 0
    with pytest.raises(ValueError, match="two words"):
        licenses.scan_licenses(none, [licenses.Template("x", "one")])


def test_plan_is_native(docs):
    plan = licenses.scan_licenses(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
