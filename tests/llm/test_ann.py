"""Nearest neighbours against brute force."""

from __future__ import annotations

import numpy as np
import pytest

from scriptorium.llm import ann


def dot(a, b):
    """In order; the built-in sum compensates its rounding."""
    total = 0.0
    for x, y in zip(a.tolist(), b.tolist()):
        total += x * y
    return total


def brute(vectors: dict[int, np.ndarray], queries, k):
    ids = np.array(sorted(vectors))
    matrix = np.array([vectors[i] for i in ids], dtype=np.float64)
    out = {}
    for q in queries:
        score = np.array([dot(vectors[q], row) for row in matrix])
        order = np.lexsort((ids, -score))
        out[q] = [(int(ids[i]), float(score[i])) for i in order if ids[i] != q][:k]
    return out


def rows_of(df):
    got = {}
    for r in df.orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(got[r["query_id"]])
    return got


@pytest.fixture(scope="module")
def clouds():
    dice = np.random.default_rng(5)
    middles = dice.standard_normal((40, 24))
    points = middles[dice.integers(0, 40, 2400)] + 0.3 * dice.standard_normal((2400, 24))
    points[800:1600] = points[800]  # a third are copies
    points[1600:1800] = points[1600] + 1e-3 * dice.standard_normal((200, 24))
    return {i: p for i, p in enumerate(points.astype(np.float32).astype(np.float64))}


def test_recall_scores_and_order(spark, clouds, monkeypatch):
    monkeypatch.setattr(ann, "BIN_ROWS", 100)
    monkeypatch.setattr(ann, "BIN_QUERIES", 30)
    table = spark.createDataFrame(
        [(i, v.tolist(), 1, 2) for i, v in clouds.items()],
        "vec_id long, embedding array<float>, leaf int, id int").repartition(3)
    queries = table.filter("vec_id % 20 = 0")
    got = rows_of(ann.nearest(table, queries))
    exact = brute(clouds, [i for i in clouds if i % 20 == 0], 20)
    assert got.keys() == exact.keys()
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in exact[q]}) for q in exact)
    assert hits >= 0.9 * sum(map(len, exact.values()))
    for q, some in got.items():
        assert len(some) == 20 and q not in dict(some)
        assert some == sorted(some, key=lambda x: (-x[1], x[0]))
        for i, score in some:
            assert score == dot(clouds[q], clouds[i])
    whole = rows_of(ann.nearest(table, queries, recall=1.0))
    assert sum(whole[q] == exact[q] for q in exact) >= 0.95 * len(exact)


def test_odd_vectors_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    table = spark.createDataFrame(
        [(0, [1.0, 2.0]), (1, None), (2, [0.0, 0.0]), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, [None, 1.0]),
         (6, [1.0, 2.0]), (7, [-1.0, 0.5]), (7, [-1.0, 0.5]), (None, [1.0, 1.0]), (8, [1.0, 2.0, 3.0]), (9, [])],
        "vec_id long, embedding array<double>")
    assert rows_of(ann.nearest(table, table)) == {
        0: [(6, 5.0), (7, 0.0)], 6: [(0, 5.0), (7, 0.0)], 7: [(0, 0.0), (6, 0.0)]}
    assert ann.nearest(table.limit(0), table).count() == 0
    assert ann.nearest(table, table.limit(0)).count() == 0
    assert ann.nearest(table.filter("vec_id = 0"), table.filter("vec_id = 0")).count() == 0


def test_fewer_leaves_are_read_than_there_are(clouds):
    vectors = np.array(list(clouds.values()))
    tree = ann.fit_tree(vectors)
    leaf = tree.leaf_of(vectors)
    best = ann.Best(vectors[:400:20], np.arange(0, 400, 20), 20)
    best.offer(np.arange(20), vectors, np.arange(len(vectors)), np.arange(len(vectors)))
    q, _, r, _ = best.merge()
    visits = ann.calibrate(tree, vectors[:400:20], list(zip(q.tolist(), leaf[r].tolist())), 0.95)
    assert 1 <= visits < sum(not c for c in tree.children) / 2
    seen = [set(tree.leaves_in_order(p, visits)) for p in vectors[:400:20] @ tree.centers.T]
    assert np.mean([leaf[i] in seen[j] for j, i in zip(q, r)]) >= 0.95
