from __future__ import annotations

from pyspark.sql import functions as F

from scriptorium.operators.changes import insert_absent, met_keys
from scriptorium.operators.pruning import key_intervals, within
from scriptorium.schemas import IDS_PER_BUCKET
from scriptorium.sinks.tables import append, update_rows, upsert_rows
from scriptorium.sources.catalog import table


def test_intervals_hold_every_key(spark):
    keys = spark.sql("SELECT id * 7 AS k FROM range(500) UNION ALL SELECT null")
    bounds = key_intervals(keys, "k", 8)
    assert 1 <= len(bounds) <= 8
    assert keys.filter("k is not null").filter(~within(F.col("k"), bounds)).count() == 0
    assert all(high < low for (_, high), (low, _) in zip(bounds, bounds[1:]))
    assert key_intervals(keys.filter("k is null"), "k") == []
    assert keys.filter(within(F.col("k"), [])).count() == 0


def test_bounds_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "keys")
    spark.range(100).selectExpr("concat('p', id) AS k").write.parquet(path)
    plan = spark.read.parquet(path).filter(within(F.col("k"), [("p1", "p2"), ("p5", "p6")]))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [Or(And(GreaterThanOrEqual(k,p1),LessThanOrEqual(k,p2))" in text


def vectors(spark, ids, model):
    return spark.createDataFrame([(i, [1.0], model) for i in ids],
                                 "paper_id long, embedding array<float>, model_used string")


def folders(spark, db, name):
    """Per id range the folders of its files."""
    rows = spark.table(f"{db}.{name}").select("id_bucket", F.regexp_replace(
        F.col("_metadata.file_path"), "/[^/]*$", "").alias("folder"))
    return {(r["id_bucket"], r["folder"]) for r in rows.distinct().collect()}


def test_upsert_rewrites_only_ranges_with_a_hit(spark, db):
    far, name = IDS_PER_BUCKET, "paper_embeddings"
    append(vectors(spark, [1, 2, far + 1, 2 * far + 1], "old"), name, db)
    before = folders(spark, db, name)
    new = vectors(spark, [2, 3, far + 2, 3 * far + 1, None], "new")
    assert upsert_rows(new, name, db) == [0]
    after = folders(spark, db, name)
    assert {b for b, f in before - after} == {0}  # the others keep their files
    got = {r["paper_id"]: r["model_used"] for r in table(spark, name, db).collect()}
    assert got == {1: "old", 2: "new", 3: "new", far + 1: "old", far + 2: "new",
                   2 * far + 1: "old", 3 * far + 1: "new"}
    assert upsert_rows(new, name, db) == [0, 1, 3]  # again: the same rows
    assert table(spark, name, db).count() == 7
    assert upsert_rows(new.limit(0), name, db) == []
    twice = vectors(spark, [2, 9], "b").unionByName(vectors(spark, [2, 9], "a"))
    upsert_rows(twice, name, db, order=[F.col("model_used")])
    got = sorted((r["paper_id"], r["model_used"]) for r in
                 table(spark, name, db).filter("paper_id in (2, 9)").collect())
    assert got == [(2, "a"), (9, "a")]


def test_update_by_another_key(spark, db):
    papers = spark.createDataFrame(
        [(1, "a"), (2, "b"), (IDS_PER_BUCKET + 1, "c")], "id long, arxiv_id string"
    ).selectExpr("*", "arxiv_id AS title")
    append(papers, "papers", db)
    paths = spark.createDataFrame([("c", "x"), ("zz", "y")], "arxiv_id string, pdf_object_path string")
    before = folders(spark, db, "papers")
    assert update_rows(paths, "papers", "arxiv_id", "pdf_object_path", db) == [1]
    assert {b for b, f in before - folders(spark, db, "papers")} == {1}
    got = {r["arxiv_id"]: r["pdf_object_path"] for r in table(spark, "papers", db).collect()}
    assert got == {"a": None, "b": None, "c": "x"}
    missing = F.col("pdf_object_path").isNull()
    assert update_rows(paths, "papers", "arxiv_id", "pdf_object_path", db, of=missing) == []
    assert update_rows(paths.limit(0), "papers", "arxiv_id", "pdf_object_path", db) == []


def test_a_small_batch_does_not_shuffle_the_stored_keys(spark, tmp_path):
    path = str(tmp_path / "stored")
    spark.range(200_000).selectExpr("concat('p', id) AS k").write.parquet(path)
    batch = str(tmp_path / "batch")  # written, as a staged batch is: Spark knows its size
    spark.createDataFrame([("p5",), ("x",), ("x",), (None,)], "k string").write.parquet(batch)
    new = spark.read.parquet(batch)
    met = met_keys(spark.read.parquet(path), new, ["k"])
    assert [r["k"] for r in met.collect()] == ["p5"]
    text = met._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text
    absent = insert_absent(spark.read.parquet(path), new, ["k"])
    assert [r["k"] for r in absent.collect()] == ["x"]
