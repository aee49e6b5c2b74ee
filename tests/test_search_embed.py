from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.ml.feature import HashingTF
from pyspark.sql import functions as F

from scriptorium.functions import vector as V
from scriptorium.operators import search
from scriptorium.operators.embed import ClientEmbedder, HashingEmbedder, embed, pending


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(4)
    rows = [(i, [rng.gauss(0, 1) for _ in range(16)]) for i in range(400)]
    rows += [(400, None), (401, [0.0] * 16), (402, [1.0] * 3)]
    return spark.createDataFrame(rows, "paper_id long, embedding array<float>").cache()


def brute_force(corpus, query, k):
    q = np.asarray(query, dtype="float64")
    scored = []
    for row in corpus.collect():
        v = np.asarray(row["embedding"] or [], dtype="float64")
        if len(v) == len(q) and np.linalg.norm(v) > 0:
            scored.append((1 - v @ q / np.linalg.norm(v) / np.linalg.norm(q), row["paper_id"]))
    return [i for _, i in sorted(scored)[:k]]


def test_knn_equals_brute_force(corpus):
    query = search.vector_of(corpus, 7)
    nearest = search.knn(corpus, query, 25).collect()
    assert [r["paper_id"] for r in nearest] == brute_force(corpus, query, 25)
    distances = [r["distance"] for r in nearest]
    assert distances == sorted(distances)
    assert 0 <= distances[0] < 1e-9 and distances[-1] <= 2


def test_rows_without_a_distance_come_last(corpus):
    query = search.vector_of(corpus, 7)
    everything = search.knn(corpus, query, 1000).collect()
    assert len(everything) == 403
    assert [r["paper_id"] for r in everything[-3:]] == [400, 401, 402]
    assert all(r["distance"] is None for r in everything[-3:])


def test_batch_scores_equal_the_sql_expression(corpus):
    query = search.vector_of(corpus, 11)
    both = corpus.select(
        search.distance_to(query)("embedding").alias("a"),
        V.cosine_distance(F.col("embedding"), V.literal(query)).alias("b"),
    ).collect()
    for row in both:
        assert (row["a"] is None) == (row["b"] is None)
        assert row["a"] is None or abs(row["a"] - row["b"]) < 1e-12


def test_a_null_element_gives_no_distance(spark):
    df = spark.createDataFrame([(1, [1.0, None]), (2, [1.0, 0.0])],
                               "paper_id long, embedding array<float>")
    got = {r["paper_id"]: r["distance"] for r in search.knn(df, [1.0, 0.0], 5).collect()}
    assert got == {1: None, 2: 0.0}


def test_many_queries_equal_one_after_the_other(spark, corpus):
    asked = corpus.filter("paper_id % 7 = 0 or paper_id >= 400").withColumnRenamed("paper_id", "asked")
    copies = corpus.unionByName(corpus.filter("paper_id < 30").select((corpus.paper_id + 500).alias("paper_id"), "embedding"))
    for block in (4096, 20):
        got = {}
        for r in search.knn_many(asked, copies, 25, block=block).orderBy("query_id", "rank").collect():
            got.setdefault(r["query_id"], []).append(r["paper_id"])
            assert r["rank"] == len(got[r["query_id"]])
        # The query of three elements has one row of its length, itself.
        assert got.pop(402) == [402]
        assert sorted(got) == list(range(0, 400, 7))
        for query, found in got.items():
            assert found == brute_force(copies, search.vector_of(corpus, query), 25)
    assert search.knn_many(asked, corpus.limit(0)).count() == 0
    assert search.knn_many(asked.limit(0), corpus).count() == 0


def test_a_row_without_a_paper_keeps_its_place(spark, corpus):
    papers = spark.createDataFrame([(7, "seven")], "id long, title string")
    nearest = search.knn(corpus, search.vector_of(corpus, 7), 5)
    got = search.with_titles(nearest, papers).collect()
    assert [r["paper_id"] for r in got] == brute_force(corpus, search.vector_of(corpus, 7), 5)
    assert [r["title"] for r in got] == ["seven", None, None, None, None]


def test_unit_is_linear_in_the_dimension(spark):
    import time

    wide = spark.range(2000).select(F.transform(F.sequence(F.lit(1), F.lit(768)), lambda i: (i % 7 + 1).cast("float")).alias("v"))
    begun = time.perf_counter()
    total = wide.select(V.unit(F.col("v")).alias("u")).agg(F.sum(F.aggregate("u", F.lit(0.0), lambda a, x: a + x * x))).first()[0]
    assert abs(total - 2000) < 1e-2
    assert time.perf_counter() - begun < 10


def test_unknown_vector(corpus):
    with pytest.raises(LookupError):
        search.vector_of(corpus, 999)
    with pytest.raises(LookupError):
        search.vector_of(corpus, 400)


TEXTS = [(1, "a b b"), (2, "b a B"), (3, ""), (4, None), (5, "other words here")]


def test_hashing_embedder(spark):
    df = spark.createDataFrame(TEXTS, "paper_id long, text string")
    got = {r["paper_id"]: r for r in embed(df, HashingEmbedder(64), "m").collect()}
    hasher = HashingTF(numFeatures=64)
    want = np.zeros(64)
    for word in ("a", "b", "b"):
        want[hasher.indexOf(word)] += 1
    np.testing.assert_allclose(got[1]["embedding"], want / np.linalg.norm(want), atol=1e-6)
    assert got[1]["embedding"] == got[2]["embedding"] != got[5]["embedding"]
    assert {len(r["embedding"]) for r in got.values()} == {64}
    assert {r["model_used"] for r in got.values()} == {"m"}


def test_client_embedder_is_called_in_batches(spark):
    def connect():
        def client(texts):
            assert len(texts) <= 2
            return [[float(len(t or "")), 1.0] for t in texts]

        return client

    df = spark.createDataFrame(TEXTS, "paper_id long, text string")
    got = {r["paper_id"]: r["embedding"] for r in embed(df, ClientEmbedder(connect, 2)).collect()}
    assert got == {i: [float(len(t or "")), 1.0] for i, t in TEXTS}


def test_pending(spark):
    inputs = spark.createDataFrame(TEXTS, "paper_id long, text string")
    done = spark.createDataFrame([(1, "m"), (2, "old")], "paper_id long, model_used string")

    def ids(df):
        return sorted(r["paper_id"] for r in df.collect())

    assert ids(pending(inputs, done)) == [3, 4, 5]
    assert ids(pending(inputs, done, "m")) == [2, 3, 4, 5]
    assert ids(pending(inputs, done, recompute=True)) == [1, 2, 3, 4, 5]


def test_inverted_file_is_exact_and_reads_a_part(spark, tmp_path):
    from scriptorium.operators.inverted import Inverted, write_inverted

    rng = np.random.default_rng(3)
    middles = rng.standard_normal((12, 16))
    points = middles[np.arange(1200) % 12] + 0.2 * rng.standard_normal((1200, 16))
    points[100:140] = points[100]
    rows = [(i, p.tolist()) for i, p in enumerate(points)]
    rows += [(1200, None), (1201, [0.0] * 16), (1202, [1.0] * 3), (1203, [float("nan")] * 16)]
    corpus = spark.createDataFrame(rows, "paper_id long, embedding array<float>")
    path = str(tmp_path / "inverted")
    write_inverted(corpus, path, 16)
    index = Inverted(spark, path)
    assert index.rows().count() == 1204
    least = 1200
    for query_id in (0, 7, 100, 555):
        query = search.vector_of(corpus, query_id)
        for k in (1, 20, 150):
            want = [tuple(r) for r in search.knn(corpus, query, k).collect()]
            assert [tuple(r) for r in index.search(query, k).collect()] == want
        least = min(least, index.rows(index.needed(query, 20)).count())
        some = index.search_some(query, 20, share=0.3)
        exact = {r["paper_id"] for r in search.knn(corpus, query, 20).collect()}
        assert len({r["paper_id"] for r in some.collect()} & exact) >= 18
        assert "PartitionFilters: [bucket" in some._jdf.queryExecution().toString()
    assert least < 600
    query = search.vector_of(corpus, 3)
    assert "PartitionFilters: [bucket" in index.search(query, 20)._jdf.queryExecution().toString()
    everything = index.search(query, 2000).collect()
    assert sorted(r["paper_id"] for r in everything) == list(range(1204))
    assert [r["paper_id"] for r in index.search([0.0] * 16, 5).collect()] == [0, 1, 2, 3, 4]
    write_inverted(corpus.filter("paper_id >= 1200"), str(tmp_path / "none"), 16)
    assert [r["paper_id"] for r in Inverted(spark, str(tmp_path / "none")).search(query, 3).collect()] == [1200, 1201, 1202]


def test_many_queries_take_memory_by_tiles():
    import tracemalloc

    rng = np.random.default_rng(3)
    for rows in (rng.standard_normal((4096, 16)), np.ones((4096, 16))):
        queries, ids = rows[:2048].copy(), np.arange(4096)
        top = search.TopRows(queries, 10)
        tracemalloc.start()
        top.add(rows, ids)
        _, peak = tracemalloc.get_traced_memory()
        tracemalloc.stop()
        # A matrix of all pairs alone would be 64 MB.
        assert peak < 45e6
