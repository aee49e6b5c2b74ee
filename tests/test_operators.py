from __future__ import annotations

import itertools
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from scriptorium.operators import changes, duplicates, links, skew
from scriptorium.operators.clean import clean
from scriptorium.operators.ids import assign_ids, last_id
from tests.conftest import record


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns or df.columns).collect())


# Skew


def test_pairs_with_a_hot_key_equal_brute_force(spark):
    data = [(1, m) for m in range(60)] + [(2, m) for m in (5, 3, 9)] + [(3, 1)]
    df = spark.createDataFrame(data, "k long, m long")
    got = rows(skew.member_pairs(df, "k", "m", block=7))
    want = []
    for key in (1, 2, 3):
        members = sorted(m for k, m in data if k == key)
        want += [(key, a, b) for a, b in itertools.combinations(members, 2)]
    assert got == sorted(want)


def test_every_block_pair_meets_once(spark):
    data = [(k, m) for k in range(5) for m in range(20)] + [(9, None), (None, 1), (7, 1), (7, 1), (7, 2)]
    df = spark.createDataFrame(data, "k long, m long")
    whole = rows(skew.member_pairs(df, "k", "m"))
    assert len(whole) == 5 * 190 + 2  # a repeated row is paired twice
    for block in (1, 2, 6):
        assert rows(skew.member_pairs(df, "k", "m", block=block)) == whole


def test_rank_desc_is_sql_rank(spark):
    data = [("d1", t, n) for t, n in zip("abcdef", [5, 5, 3, 1, 1, 1])] + [("d2", "a", 1)]
    df = spark.createDataFrame(data, "day string, topic string, n long")
    got = rows(skew.rank_desc(df, ["day"], "n"), "day", "topic", "rank")
    df.createOrReplaceTempView("ranked_input")
    want = spark.sql(
        "SELECT day, topic, rank() OVER (PARTITION BY day ORDER BY n DESC) FROM ranked_input"
    )
    assert got == sorted(tuple(r) for r in want.collect())


def test_top_per_group_past_the_threshold(spark):
    data = [(g, i) for g in "ab" for i in range(300)]
    df = spark.createDataFrame(data, "g string, i long")
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", "10")
    try:
        got = rows(skew.top_per_group(df, ["g"], [F.desc("i")], 25))
    finally:
        spark.conf.unset("spark.sql.optimizer.windowGroupLimitThreshold")
    assert got == sorted((g, i) for g in "ab" for i in range(275, 300))


# Ids


@pytest.mark.parametrize("partitions", [1, 3, 8])
def test_ids_are_dense_and_in_key_order(spark, partitions):
    names = [f"n{i:04d}" for i in range(500)]
    random.Random(1).shuffle(names)
    df = spark.createDataFrame([(n, n.upper()) for n in names], "name string, other string")
    got = rows(assign_ids(df, "name", 40, partitions), "id", "name", "other")
    assert got == [(41 + i, n, n.upper()) for i, n in enumerate(sorted(names))]


def test_ids_of_nothing(spark):
    empty = spark.createDataFrame([], "name string")
    assert assign_ids(empty, "name").count() == 0
    assert last_id(spark.createDataFrame([], "id long")) == 0


# Cleaning


def test_clean(spark, bronze):
    df = bronze(
        [
            record("1", title="  Two\n words\t"),
            record("1", title="A later copy"),
            record(None),
            record("2", abstract=None),
            record("3", title=""),
        ]
    )
    got = clean(df, order=[F.col("source_row")])
    assert rows(got, "arxiv_id", "title") == [("1", "Two words"), ("3", "")]
    assert len(got.columns) == 9


def test_key_is_made_unique_before_whitespace(spark, bronze):
    df = bronze([record("1", title="One  title"), record("2", title="One title")])
    titles = [r["title"] for r in clean(df, order=[F.col("source_row")]).collect()]
    assert titles == ["One title", "One title"]


# Links


def test_unnest_with_ordinal(spark):
    df = spark.createDataFrame([(1, ["x", "y", "x"]), (2, []), (3, None)], "id long, a array<string>")
    got = rows(links.unnest_ordinal(df, "a", "v", "pos"))
    assert got == [(1, "x", 1), (1, "x", 3), (1, "y", 2)]


def test_membership_join_counts_a_repeated_code_once(spark):
    df = spark.createDataFrame([(1, ["a", "a", "b"]), (2, ["z"])], "id long, codes array<string>")
    dim = spark.createDataFrame([(10, "a"), (11, "b")], "cid long, code string")
    assert rows(links.membership_join(df, "codes", dim, "code"), "id", "cid") == [(1, 10), (1, 11)]


def test_author_and_category_links(spark):
    staging = spark.createDataFrame(
        [
            ("p1", ["Ada", "Ben", "Ada", None, "Nobody"], "x", ["x", "y", "x"]),
            ("p2", [], None, ["y"]),
            ("p3", ["Ben"], "q", None),
            ("gone", ["Ada"], "x", ["x"]),
        ],
        "arxiv_id string, authors array<string>, primary_category string, "
        "all_categories array<string>",
    )
    papers = spark.createDataFrame([(1, "p1"), (2, "p2"), (3, "p3")], "id long, arxiv_id string")
    authors = spark.createDataFrame([(7, "Ada"), (8, "Ben")], "id long, name string")
    codes = spark.createDataFrame([(5, "x"), (6, "y")], "id long, code string")
    assert rows(links.author_links(staging, papers, authors)) == [(1, 7, 1), (1, 8, 2), (3, 8, 1)]
    assert rows(links.category_links(staging, papers, codes)) == [
        (1, 5, True),
        (1, 6, False),
        (2, 6, False),
    ]


# Changes


def test_insert_absent_never_replaces(spark):
    existing = spark.createDataFrame([("a", 1)], "k string, v long")
    new = spark.createDataFrame([("a", 9), ("b", 3), ("b", 2), (None, 5)], "k string, v long")
    assert rows(changes.insert_absent(existing, new, ["k"], [F.col("v")])) == [("b", 2)]


def test_insert_absent_links_keeps_the_least_position(spark):
    schema = "p long, a long, pos int"
    existing = spark.createDataFrame([(1, 1, 4)], schema)
    new = spark.createDataFrame([(1, 1, 1), (1, 2, 5), (1, 2, 3), (2, 1, 1)], schema)
    got = changes.insert_absent_links(existing, new, ["p", "a"], "pos")
    assert rows(got) == [(1, 2, 3), (2, 1, 1)]


def test_conflicts(spark):
    schema = "arxiv_id string, title string"
    existing = spark.createDataFrame([("1v1", "Known")], schema)
    new = spark.createDataFrame(
        [("1v2", "Known"), ("2v1", "Twin"), ("3v1", "Twin"), ("4v1", "Free")], schema
    )
    order = [F.col("arxiv_id")]
    ok, bad = changes.split_conflicts(existing, new, "title", "arxiv_id", order)
    assert rows(ok, "arxiv_id") == [("2v1",), ("4v1",)]
    assert rows(bad, "arxiv_id") == [("1v2",), ("3v1",)]
    with pytest.raises(changes.ConflictError, match="Known"):
        changes.split_conflicts(existing, new, "title", "arxiv_id", order, mode="strict")
    fine = new.filter("title = 'Free'")
    ok, bad = changes.split_conflicts(existing, fine, "title", "arxiv_id", order, mode="strict")
    assert (ok.count(), bad.count()) == (1, 0)


def test_upsert_and_update(spark):
    existing = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    new = spark.createDataFrame([(2, "B"), (3, "C")], "k long, v string")
    assert rows(changes.upsert(existing, new, "k")) == [(1, "a"), (2, "B"), (3, "C")]
    updates = spark.createDataFrame([(1, None), (2, "Z"), (9, "Q")], "k long, v string")
    assert rows(changes.update_from(existing, updates, "k", "v")) == [(1, "a"), (2, "Z")]


def test_keep_latest_and_cascade(spark):
    df = spark.createDataFrame(
        [(1, "t"), (3, "t"), (2, "u"), (4, None), (5, None)], "id long, title string"
    )
    kept = changes.keep_latest(df, "title")
    assert rows(kept, "id") == [(2,), (3,), (4,), (5,)]
    child = spark.createDataFrame([(1, "x"), (3, "y"), (None, "z")], "paper_id long, v string")
    gone = df.join(kept, "id", "left_anti")
    left = {r["v"] for r in changes.cascade(child, gone, "paper_id").collect()}
    assert left == {"y", "z"}


# Duplicates


def test_duplicate_docs(spark):
    data = [(1, "t", "a", "p1"), (2, "t", "a", "p2"), (3, "t", "b", "p3"), (4, None, "a", "p4"),
            (5, None, "a", "p5"), (6, "u", "a", "p6")]
    df = spark.createDataFrame(data, "id long, title string, abstract string, arxiv_id string")
    got = duplicates.duplicate_docs(df, ["title", "abstract"], "id", "arxiv_id").collect()
    assert sorted((str(r["title"]), r["part"], r["n"], r["ids"], r["others"]) for r in got) == [
        ("None", 0, 2, [4, 5], ["p4", "p5"]),
        ("t", 0, 2, [1, 2], ["p1", "p2"]),
    ]


def test_a_large_group_of_copies_comes_in_parts(spark):
    ids = random.Random(2).sample(range(1, 1000), 400)
    df = spark.createDataFrame([(i, "same", f"p{i}") for i in ids], "id long, t string, x string")
    parts = duplicates.duplicate_docs(df, ["t"], "id", "x", part_rows=50).orderBy("part").collect()
    assert [len(p["ids"]) for p in parts] == [50] * 8
    assert [i for p in parts for i in p["ids"]] == sorted(ids)
    assert [x for p in parts for x in p["others"]] == [f"p{i}" for i in sorted(ids)]
    members = duplicates.duplicate_members(df, ["t"], "id", "x")
    assert rows(members, "ordinal", "id") == list(enumerate(sorted(ids), 1))
    assert duplicates.duplicate_members(df.limit(0), ["t"], "id", "x").count() == 0


def test_duplicate_vectors_by_value(spark):
    df = spark.sql(
        """SELECT * FROM VALUES
        (1L, array(float(0), float(1))), (2L, array(float('-0.0'), float(1))),
        (3L, array(float(2), float(1))), (4L, cast(null AS array<float>)),
        (5L, cast(null AS array<float>)) AS v(paper_id, embedding)"""
    )
    papers = spark.createDataFrame([(i, f"t{i}") for i in range(1, 6)], "id long, title string")
    got = duplicates.duplicate_vectors(df, papers)
    assert rows(got, "paper_id", "title", "n") == [(1, "t1", 2), (2, "t2", 2)]


def test_duplicate_vectors_against_brute_force(spark):
    rng = random.Random(3)
    vectors = [[float(rng.randint(0, 2)) for _ in range(3)] for _ in range(80)]
    df = spark.createDataFrame(list(enumerate(vectors)), "paper_id long, embedding array<float>")
    papers = spark.createDataFrame([(i, f"t{i}") for i in range(80)], "id long, title string")
    counts = Counter(map(tuple, vectors))
    want = sorted((i, counts[tuple(v)]) for i, v in enumerate(vectors) if counts[tuple(v)] > 1)
    assert rows(duplicates.duplicate_vectors(df, papers), "paper_id", "n") == want


def test_cascade_goes_through_all_levels(spark, monkeypatch):
    """A table that refers to a child: rows two levels below go as well."""
    from scriptorium.schemas import TABLES, TableSpec, referrers

    notes = TableSpec(TABLES["paper_enrichments"].schema, parents={
        "enrichment_id": ("paper_enrichments", "id"), "author_id": ("authors", "id")})
    monkeypatch.setitem(TABLES, "notes", notes)
    assert referrers("papers").index("notes") > referrers("papers").index("paper_enrichments")
    tables = {
        "papers": spark.createDataFrame([(1,), (2,)], "id long"),
        "paper_enrichments": spark.createDataFrame([(10, 1), (20, 2), (30, None)], "id long, paper_id long"),
        "notes": spark.createDataFrame(
            [(1, 10, 5), (2, 20, 5), (3, None, None), (4, 30, 6)], "id long, enrichment_id long, author_id long"),
    }
    gone = spark.createDataFrame([(1,), (1,), (7,), (None,)], "id long")
    left = changes.surviving_rows(tables, "papers", gone)
    assert {n: sorted(r["id"] for r in rows.collect()) for n, rows in left.items()} == {
        "papers": [2], "paper_enrichments": [20, 30], "notes": [2, 3, 4]}
    dead = changes.deleted_rows(tables, "papers", gone)
    assert [r["id"] for r in dead["notes"].collect()] == [1]


def test_member_pairs_of_new_rows_are_all_less_the_old_ones(spark):
    links = [(k, m, (k + m) % 3 == 0 or None) for k in range(6) for m in range(9)] + [(1, 2, True), (1, 2, None)]
    df = spark.createDataFrame(links, "k int, m int, new boolean")
    whole = Counter(map(tuple, skew.member_pairs(df, "k", "m").collect()))
    old = Counter(map(tuple, skew.member_pairs(df.filter("new is null"), "k", "m").collect()))
    for block in (2048, 4):
        got = Counter(map(tuple, skew.member_pairs(df, "k", "m", block=block, new="new").collect()))
        assert got == whole - old and got
