"""Vector expressions, embeddings, and exact top-k against brute force."""

from __future__ import annotations

import hashlib
import json

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from feedlake.functions.vectors import (
    cosine, l2_normalize, namespace, vector_metadata, zero_vector,
)
from feedlake.operators import topk
from feedlake.operators.embed import embed_text, hashed_words, zeros
from feedlake.operators.retrieve import top_k_vectors, vector_hits

DIM = 6


def test_cosine_and_norm(spark):
    df = spark.createDataFrame(
        [([3.0, 4.0], [3.0, 4.0]), ([0.0, 0.0], [1.0, 2.0]), ([1.0, 0.0], [-1.0, 0.0])],
        "a array<float>, b array<double>",
    )
    rows = df.select(cosine(F.col("a"), F.col("b")), l2_normalize(F.col("a"))).collect()
    assert [round(r[0], 12) for r in rows] == [1.0, 0.0, -1.0]
    assert [list(r[1]) for r in rows] == [[0.6, 0.8], [0.0, 0.0], [1.0, 0.0]]
    assert spark.range(1).select(zero_vector(3)).first()[0] == [0.0] * 3
    bad = spark.createDataFrame([([1.0], [1.0, 2.0])], "a array<double>, b array<double>")
    with pytest.raises(PySparkException, match="unequal length"):
        bad.select(cosine(F.col("a"), F.col("b"))).collect()


def test_namespaces(spark):
    names = [" EMEA ", "North America", "", None, "\t\n", "　Asia  Pacific "]
    df = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "i int, n string")
    got = [r[0] for r in df.orderBy("i").select(namespace(F.col("n"))).collect()]
    assert got == ["emea", "north_america", "global", "global", "global", "asia__pacific"]


def test_metadata_is_laid_out_as_python_does(spark):
    row = dict(
        chunk_id="a_0", article_id="a", feed_id='f"q', region="emea", language="en", chunk_index=3,
        published_at="2025-01-01 05:00:00.25", source_url="http://x/\\y",
        chunk_text='say "hi"' + "x" * 2000,
    )
    full = spark.createDataFrame([row]).withColumn(
        "published_at", F.col("published_at").cast("timestamp")
    ).withColumn("chunk_index", F.col("chunk_index").cast("int"))
    got = full.select(vector_metadata()).first()[0]
    wanted = dict(row, published_at="2025-01-01 05:00:00.250000", chunk_text=row["chunk_text"])
    assert got == json.dumps(wanted)
    bare = full.withColumn("published_at", F.lit(None).cast("timestamp")).withColumn(
        "source_url", F.lit("")
    )
    got = json.loads(bare.select(vector_metadata({"region": F.lit("r"), "z": F.lit(1)}, 5)).first()[0])
    assert list(got) == [
        "chunk_id", "article_id", "feed_id", "region", "language", "chunk_index", "chunk_text", "z"
    ]
    assert (got["region"], got["chunk_text"], got["z"]) == ("r", "say \"", 1)


def test_embeddings(spark):
    texts = ["a b a", "", None, "ü ü ü x"] + [f"w{i} w{i + 1}" for i in range(300)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    rows = df.select("i", embed_text(F.col("t"), batch=7).alias("v")).orderBy("i").collect()
    for r in rows:
        words = (texts[r["i"]] or "").split()
        wanted = np.zeros(384)
        for w in words:
            wanted[int(hashlib.md5(w.encode()).hexdigest()[:8], 16) % 384] += 1
        if words:
            wanted /= np.linalg.norm(wanted)
        np.testing.assert_allclose(r["v"], wanted, atol=1e-12)
    assert hashed_words(10)([]).shape == (0, 10)
    assert df.select(embed_text(F.col("t"), lambda: zeros(4)).alias("v")).first()["v"] == [0.0] * 4


def make(spark, n=400, n_queries=9, seed=3):
    rng = np.random.default_rng(seed)
    spaces, languages = ["global", "emea", "one_big"], ["en", "de", None]
    vectors = []
    for i in range(n):
        # Two thirds in one namespace, many exact copies, and some zeros.
        v = rng.integers(-2, 3, DIM).astype(float) if i % 10 else np.zeros(DIM)
        vectors.append(
            (f"v{i:04d}", spaces[2 if i % 3 else i % 2], languages[i % 3], [float(x) for x in v])
        )
    queries = []
    for q in range(n_queries):
        v = rng.integers(-2, 3, DIM).astype(float) if q else np.zeros(DIM)
        queries.append(
            (q, [None, "One Big", " EMEA", "nowhere"][q % 4], ["en", "", None][q % 3],
             [float(x) for x in v])
        )
    return (
        vectors, queries,
        spark.createDataFrame(
            vectors, "id string, namespace string, language string, values array<double>"
        ).repartition(5),
        spark.createDataFrame(
            queries, "query_id int, region string, language string, embedding array<double>"
        ),
    )


def brute(vectors, queries, k, by_namespace, by_language):
    out = []
    for query_id, region, language, e in queries:
        space = (region or "global").strip().lower().replace(" ", "_")
        scored = []
        for vid, vspace, vlanguage, v in vectors:
            if by_namespace and space != vspace:
                continue
            if by_language and language and vlanguage != language:
                continue
            scale = np.linalg.norm(e) * np.linalg.norm(v)
            scored.append((-round(float(np.dot(e, v) / scale), 9) if scale else 0.0, vid))
        out += [
            (query_id, rank, vid, round(-score, 6) + 0.0)
            for rank, (score, vid) in enumerate(sorted(scored)[:k], 1)
        ]
    return sorted(out)


def rows_of(df):
    return sorted((r["query_id"], r["rank"], r["id"], round(r["score"], 6) + 0.0) for r in df.collect())


@pytest.mark.parametrize("by_namespace,by_language", [(0, 0), (0, 1), (1, 0), (1, 1)])
@pytest.mark.parametrize("k", [1, 8, 500])
def test_top_k_is_exact(spark, by_namespace, by_language, k):
    vectors, queries, vdf, qdf = make(spark)
    found = top_k_vectors(vdf, qdf, k, bool(by_namespace), bool(by_language))
    assert rows_of(found) == brute(vectors, queries, k, by_namespace, by_language)


def test_small_steps_and_grid_give_the_same(spark, monkeypatch):
    vectors, queries, vdf, qdf = make(spark, 300, 25)
    wanted = brute(vectors, queries, 8, True, True)
    # Beyond two queries per block the grid takes over.
    assert rows_of(top_k_vectors(vdf, qdf, 8, max_queries=2)) == wanted
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "13")
    try:
        assert rows_of(top_k_vectors(vdf, qdf, 8)) == wanted
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_grid_of_many_cells(spark):
    from feedlake.operators.retrieve import _prepare_cosine

    vectors, queries, vdf, qdf = make(spark, 300, 25)
    spec = topk.TopK(
        _prepare_cosine, ["query_id", "space", "language", "embedding"],
        ["id", "space", "language", "values"], ["id"], 8, 10**9,
    )
    asked = qdf.select(
        "query_id", namespace(F.col("region")).alias("space"),
        F.nullif("language", F.lit("")).alias("language"), "embedding",
    )
    vdf = vdf.withColumnRenamed("namespace", "space")
    found = topk.top_k(vdf, asked, spec, F.lit(1), max_queries=4, cell_rows=50)
    got = sorted((r["query_id"], r["rank"], r["id"]) for r in found.collect())
    assert got == [r[:3] for r in brute(vectors, queries, 8, True, True)]


def test_candidate_floor_in_small_steps(monkeypatch):
    """Many small steps inside one task keep the exact best."""
    import pandas as pd

    monkeypatch.setattr(topk, "SCORE_CELLS", 1)
    rng = np.random.default_rng(1)
    scores = rng.integers(0, 4, (200, 3)).astype(float)
    spec = topk.TopK(
        lambda block: lambda part: scores[part["n"].to_numpy()], ["q"], ["n"], ["n"], 5
    )
    batches = [pd.DataFrame({"n": rng.permutation(200)[:200]})]
    got = topk._scan(spec, pd.DataFrame({"q": ["a", "b", "c"]}), iter(batches))
    for q, name in enumerate("abc"):
        order = sorted(range(200), key=lambda n: (-scores[n, q], n))[:5]
        assert list(got[got["query_id"] == name]["n"]) == order


def test_unequal_lengths_are_an_error(spark):
    _, _, vdf, qdf = make(spark, 20, 3)
    short = qdf.withColumn("embedding", F.slice("embedding", 1, 3))
    with pytest.raises(PySparkException, match="unequal length"):
        top_k_vectors(vdf, short, by_namespace=False).collect()


def test_one_id_in_two_namespaces(spark):
    vectors = spark.createDataFrame(
        [("v", n, "en", v) for n, v in (("a", [1.0, 0.0]), ("b", [0.6, 0.8]))],
        "id string, namespace string, language string, values array<double>",
    )
    queries = spark.createDataFrame(
        [("q", "b", None, [1.0, 0.0])],
        "query_id string, region string, language string, embedding array<double>",
    )

    def found(**kwargs):
        return [
            (r["rank"], r["namespace"], r["score"])
            for r in top_k_vectors(vectors, queries, **kwargs).orderBy("rank").collect()
        ]

    assert found() == [(1, "b", 0.6)]
    assert found(by_namespace=False) == [(1, "a", 1.0), (2, "b", 0.6)]


def test_namespaces_prune_the_scan(spark):
    from feedlake.session import shared_dir

    _, _, vdf, qdf = make(spark, 60, 4)
    path = shared_dir(spark, "v")
    vdf.write.partitionBy("namespace").parquet(path)
    found = top_k_vectors(spark.read.schema(vdf.schema).parquet(path), qdf.filter("query_id = 1"))
    text = found._jdf.queryExecution().executedPlan().toString()
    assert "one_big" in text.split("PartitionFilters: [")[1].split("]")[0]
    assert found.count() == 8


def test_no_queries_and_no_vectors(spark):
    _, _, vdf, qdf = make(spark, 20, 3)
    assert top_k_vectors(vdf, qdf.limit(0)).count() == 0
    assert top_k_vectors(vdf.limit(0), qdf).count() == 0


def test_hits_fall_back_to_the_vectors_id(spark):
    vectors = spark.createDataFrame(
        [("a", "v1", '{"chunk_id": "c1", "chunk_text": "t"}'), ("b", "v1", '{"chunk_id": "other"}'),
         ("a", "v2", None)],
        "namespace string, id string, metadata string",
    )
    found = spark.createDataFrame(
        [("q", 1, "a", "v1", 0.5), ("q", 2, "a", "v2", None)],
        "query_id string, rank int, namespace string, id string, score double",
    )
    rows = sorted(tuple(r)[:5] for r in vector_hits(found, vectors).collect())
    assert rows == [("q", 1, "c1", 0.5, "t"), ("q", 2, "v2", 0.0, "")]


def test_a_task_holds_the_vectors_of_one_model_call(spark):
    def traced():
        import tracemalloc

        tracemalloc.start()
        held = []

        def model(texts):
            held.append(tracemalloc.get_traced_memory()[0])
            # The first calls import what the task needs.
            assert held[-1] - held[min(len(held) - 1, 5)] < 4 << 20, held
            return np.ones((len(texts), 384))

        return model

    rows = spark.range(0, 4000, 1, 1).select("id", F.when(F.col("id") % 2 == 0, F.col("id").cast("string")).alias("t"))
    out = rows.select("id", embed_text(F.col("t"), traced).alias("v"))
    got = out.agg(F.count("v"), F.min(F.size("v")), F.max(F.abs(F.col("v")[383] - 384 ** -0.5))).first()
    assert (got[0], got[1]) == (4000, 384) and got[2] < 1e-12
