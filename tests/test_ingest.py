from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from scriptorium.operators import quality, suite
from scriptorium.operators.changes import ConflictError
from scriptorium.operators.embed import ClientEmbedder, HashingEmbedder
from scriptorium.plans import ingest as I
from scriptorium.plans.embeddings import author_list, embedding_inputs, run_embedding_job
from scriptorium.plans.ingest import IngestOptions, ingest
from scriptorium.schemas import TABLES
from scriptorium.sinks.tables import append
from scriptorium.sources.catalog import all_tables, table
from scriptorium.streaming.ingest_stream import ingest_stream
from tests.conftest import record

NOW = "2026-06-03 00:00:00"

BATCH_1 = [
    record("1v1", "One", authors=["Ada", "Ben", "Ada"]),
    record("2v1", "Two", authors=["Cy"], all_categories=["cs.CL", "cs.CL"], primary_category=None),
    record("1v1", "One again"),
    record("3v1", None),
]
BATCH_2 = [
    record("2v1", "Two", authors=["Cy", "Dee"], all_categories=["cs.CL"], primary_category=None),
    record("4v1", "Four", authors=[], all_categories=["stat.ML"], primary_category="stat.ML"),
    record("5v1", "Five", authors=["Ben", None]),
]


def state(spark, db):
    """The tables by natural keys, free of surrogate ids."""
    t = all_tables(spark, db)
    p, a, c = t["papers"], t["authors"], t["categories"]
    by_author = t["paper_authors"].join(p, F.col("paper_id") == p.id).join(
        a, F.col("author_id") == a.id
    )
    by_code = t["paper_categories"].join(p, F.col("paper_id") == p.id).join(
        c, F.col("category_id") == c.id
    )
    return {
        "papers": sorted(map(tuple, p.select("arxiv_id", p.title, "abstract").collect())),
        "authors": sorted(map(tuple, a.select("name").collect())),
        "categories": sorted(map(tuple, c.select("code").collect())),
        "by_author": sorted(map(tuple, by_author.select("arxiv_id", a.name, "position").collect())),
        "by_code": sorted(map(tuple, by_code.select("arxiv_id", "code", "is_primary").collect())),
    }


def violations(spark, db):
    t = all_tables(spark, db)
    checks = [suite.evaluate(suite.standard_rules() + suite.model_rules(), t)]
    for name, spec in TABLES.items():
        checks += [quality.unique(t[name], k, f"{name}-{k}") for k in spec.unique]
        checks += [quality.not_null(t[name], c, f"{name}-{c}") for c in spec.required]
        checks += [
            quality.relationships(t[name], t[parent], fk, key, f"{name}-{fk}-parent")
            for fk, (parent, key) in spec.parents.items()
        ]
    return {r["check_name"] for r in quality.report(checks).filter("violations > 0").collect()}


def test_one_batch(spark, db, bronze):
    rejected = ingest(bronze(BATCH_1), "r1", "2026-06-02", db, NOW)
    assert rejected.count() == 0
    assert state(spark, db) == {
        "papers": [("1v1", "One", "About 1v1"), ("2v1", "Two", "About 2v1")],
        "authors": [("Ada",), ("Ben",), ("Cy",)],
        "categories": [("cs.CL",), ("cs.LG",)],
        "by_author": [("1v1", "Ada", 1), ("1v1", "Ben", 2), ("2v1", "Cy", 1)],
        "by_code": [("1v1", "cs.CL", False), ("1v1", "cs.LG", True), ("2v1", "cs.CL", False)],
    }
    ids = sorted(r["id"] for r in table(spark, "authors", db).collect())
    assert ids == [1, 2, 3]
    paper = table(spark, "papers", db).filter("arxiv_id = '1v1'").first()
    assert str(paper["updated_at"]) == "2026-06-02 10:00:00"
    assert str(paper["ingested_at"]) == NOW
    (run,) = table(spark, "ingestion_runs", db).collect()
    assert (run["run_id"], run["papers_fetched"], run["papers_new"]) == ("r1", 2, 2)
    assert (run["status"], run["error_message"]) == ("success", None)
    assert violations(spark, db) == set()


def test_same_batch_twice_changes_nothing(spark, db, bronze):
    ingest(bronze(BATCH_1), "r1", "2026-06-02", db, NOW)
    before = {n: sorted(map(str, df.collect())) for n, df in all_tables(spark, db).items()}
    ingest(bronze(BATCH_1), "r2", "2026-06-02", db, "2026-06-04 00:00:00")
    after = {n: sorted(map(str, df.collect())) for n, df in all_tables(spark, db).items()}
    runs = after.pop("ingestion_runs"), before.pop("ingestion_runs")
    assert after == before
    assert [len(r) for r in runs] == [2, 1]
    second = table(spark, "ingestion_runs", db).filter("run_id = 'r2'").first()
    assert (second["papers_fetched"], second["papers_new"]) == (2, 0)


def test_batches_one_by_one_or_together(spark, db, bronze, tmp_path):
    from scriptorium.sinks.tables import create_tables

    ingest(bronze(BATCH_1, "2026-06-02"), "r1", "2026-06-02", db, NOW)
    ingest(bronze(BATCH_2, "2026-06-03"), "r2", "2026-06-03", db, NOW)
    create_tables(spark, str(tmp_path / "together"), f"{db}_b")
    first = bronze(BATCH_1, "2026-06-02")
    both = first.unionByName(bronze(BATCH_2, "2026-06-03"))
    ingest(both, "r", "2026-06-03", f"{db}_b", NOW)
    apart, together = state(spark, db), state(spark, f"{db}_b")
    # The re-seen paper gains a link when its batch comes alone; in one batch
    # the first record of the paper is the only one.
    assert ("2v1", "Dee", 2) in apart["by_author"]
    assert [r for r in apart["by_author"] if r[1] != "Dee"] == together["by_author"]
    assert apart["papers"] == together["papers"]
    assert apart["categories"] == together["categories"]
    assert apart["by_code"] == together["by_code"]
    assert violations(spark, db) == violations(spark, f"{db}_b") == set()


def test_quarantine_and_strict(spark, db, bronze):
    ingest(bronze(BATCH_1), "r1", "2026-06-02", db, NOW)
    clash = [record("1v2", "One"), record("6v1", "Twin"), record("7v1", "Twin")]
    before = state(spark, db)
    with pytest.raises(ConflictError):
        ingest(bronze(clash), "r2", "2026-06-03", db, NOW, IngestOptions(mode="strict"))
    assert state(spark, db) == before
    failed = table(spark, "ingestion_runs", db).filter("run_id = 'r2'").first()
    assert failed["status"] == "failed" and "title" in failed["error_message"]
    rejected = ingest(bronze(clash), "r3", "2026-06-03", db, NOW)
    assert sorted(r["arxiv_id"] for r in rejected.collect()) == ["1v2", "7v1"]
    assert [p[0] for p in state(spark, db)["papers"]] == ["1v1", "2v1", "6v1"]
    assert violations(spark, db) == set()


def test_a_paper_without_a_date_is_set_aside(spark, db, bronze):
    batch = bronze([record("1v1", "Dated"), record("2v1", "Undated", published_at=None)])
    with pytest.raises(ConflictError, match="2v1"):
        ingest(batch, "r1", "2026-06-02", db, NOW, IngestOptions(mode="strict"))
    rejected = ingest(batch, "r2", "2026-06-02", db, NOW)
    assert [r["arxiv_id"] for r in rejected.collect()] == ["2v1"]
    assert [p[0] for p in state(spark, db)["papers"]] == ["1v1"]
    assert violations(spark, db) == set()


def test_titles_that_differ_in_whitespace_clash(spark, db, bronze):
    rejected = ingest(
        bronze([record("1v1", "A  b"), record("2v1", "A b\n")]), "r", "2026-06-02", db, NOW
    )
    assert [r["arxiv_id"] for r in rejected.collect()] == ["2v1"]


def test_an_interrupted_batch_is_completed_by_its_repetition(spark, db, bronze):
    staging = I.stage(bronze(BATCH_1), db)
    I.insert_papers(spark, staging, db, NOW, IngestOptions())  # and then it stopped
    ingest(bronze(BATCH_1), "r1", "2026-06-02", db, NOW)
    assert len(state(spark, db)["by_author"]) == 3
    assert violations(spark, db) == set()


def test_a_batch_that_stops_shows_nothing(spark, db, bronze, monkeypatch):
    ingest(bronze(BATCH_1), "r1", "2026-06-02", db, NOW)
    before = state(spark, db)
    whole = I.append

    def failing(df, name, *args, **kwargs):
        if name == "paper_categories":
            raise OSError("lost")
        whole(df, name, *args, **kwargs)

    monkeypatch.setattr(I, "append", failing)
    with pytest.raises(OSError):
        ingest(bronze(BATCH_2), "r2", "2026-06-03", db, NOW)
    assert state(spark, db) == before
    assert table(spark, "rejected_papers", db).count() == 0
    assert spark.table(f"{db}.papers").count() == 4  # written, not visible
    monkeypatch.setattr(I, "append", whole)
    ingest(bronze(BATCH_2), "r2", "2026-06-03", db, NOW)
    assert [p[0] for p in state(spark, db)["papers"]] == ["1v1", "2v1", "4v1", "5v1"]
    assert ("5v1", "Ben", 1) in state(spark, db)["by_author"]
    runs = {(r["run_id"], r["status"]) for r in table(spark, "ingestion_runs", db).collect()}
    assert runs == {("r1", "success"), ("r2", "failed"), ("r2", "success")}
    assert violations(spark, db) == set()


def test_two_batches_at_once_do_not_both_count(spark, db, bronze, monkeypatch):
    stage = I.stage

    def interrupted(raw, db_):
        monkeypatch.setattr(I, "stage", stage)
        ingest(bronze(BATCH_2), "other", "2026-06-03", db, NOW)
        return stage(raw, db_)

    monkeypatch.setattr(I, "stage", interrupted)
    with pytest.raises(ConflictError, match="another batch"):
        ingest(bronze(BATCH_1), "r1", "2026-06-02", db, NOW)
    assert [p[0] for p in state(spark, db)["papers"]] == ["2v1", "4v1", "5v1"]
    ingest(bronze(BATCH_1), "r1", "2026-06-02", db, NOW)
    assert [p[0] for p in state(spark, db)["papers"]] == ["1v1", "2v1", "4v1", "5v1"]
    assert violations(spark, db) == set()


def test_rejected_papers_are_kept_whole_with_a_reason(spark, db, bronze):
    batch = [
        record("1v1", "One"), record("2v1", "One", authors=["Zed"], all_categories=["x.Y"]),
        record("3v1", "Three", published_at=None),
    ]
    rejected = ingest(bronze(batch), "r1", "2026-06-02", db, NOW)
    stored = table(spark, "rejected_papers", db)
    reasons = {r["arxiv_id"]: (r["run_id"], r["reason"], str(r["rejected_at"])) for r in stored.collect()}
    assert reasons == {
        "2v1": ("r1", "title of another paper", NOW), "3v1": ("r1", "no value in published_at", NOW)}
    kept = stored.filter("arxiv_id = '2v1'").first()
    assert (kept["title"], kept["authors"], kept["all_categories"]) == ("One", ["Zed"], ["x.Y"])
    assert sorted(r["arxiv_id"] for r in rejected.collect()) == ["2v1", "3v1"]
    staged = table(spark, "staging_papers", db).count()
    assert staged == table(spark, "papers", db).count() + stored.count()
    # Names that only rejected papers have are not added.
    assert "Zed" not in {r["name"] for r in table(spark, "authors", db).collect()}
    assert "x.Y" not in {r["code"] for r in table(spark, "categories", db).collect()}


def test_planted_faults_are_found(spark, db, bronze):
    ingest(bronze(BATCH_1), "r1", "2026-06-02", db, NOW)
    append(spark.createDataFrame([(77, 1, 1)], "paper_id long, author_id long, position int"),
           "paper_authors", db)
    append(table(spark, "papers", db).filter("id = 1"), "papers", db)
    found = violations(spark, db)
    assert {"duplicate_papers", "no_orphaned_paper_authors", "unique_stg_papers_paper_id",
            "unique_stg_papers_arxiv_id", "relationships_stg_paper_authors_paper_id"} <= found


def test_updated_at_may_be_the_clock(spark, db, bronze):
    options = IngestOptions(now_as_updated=True)
    ingest(bronze(BATCH_1), "r1", "2026-06-02", db, NOW, options)
    assert {str(r["updated_at"]) for r in table(spark, "papers", db).collect()} == {NOW}


def test_object_paths_only_for_landed_objects(spark, db, bronze):
    ingest(bronze(BATCH_1), "r1", "2026-06-02", db, NOW)
    waiting = I.pending_objects(table(spark, "papers", db)).collect()
    assert sorted(r["arxiv_id"] for r in waiting) == ["1v1", "2v1"]
    landed = spark.createDataFrame([("1v1",), ("1v1",), ("9v9",)], "arxiv_id string")
    assert I.record_objects(spark, landed, db)
    paths = {r["arxiv_id"]: r["pdf_object_path"] for r in table(spark, "papers", db).collect()}
    assert paths == {"1v1": "arxiv_pdfs/1v1.pdf", "2v1": None}
    everything = spark.createDataFrame([("2v1",)], "arxiv_id string")
    assert I.record_objects(spark, everything, db)
    assert not I.record_objects(spark, everything, db)


def test_delete_cascades(spark, db, bronze):
    ingest(bronze(BATCH_1), "r1", "2026-06-02", db, NOW)
    papers = table(spark, "papers", db)
    one = papers.filter("arxiv_id = '1v1'")
    newer = one.withColumn("id", F.lit(50)).withColumn("arxiv_id", F.lit("1v9"))
    append(newer, "papers", db)
    append(one.select(F.col("id").alias("paper_id"), F.array(F.lit(1.0)).alias("embedding"),
                      F.lit("m").alias("model_used")), "paper_embeddings", db, NOW)
    I.delete_older_titles(spark, db)
    assert [p[0] for p in state(spark, db)["papers"]] == ["1v9", "2v1"]
    assert state(spark, db)["by_author"] == [("2v1", "Cy", 1)]
    assert table(spark, "paper_embeddings", db).count() == 0
    assert table(spark, "authors", db).count() == 3


def test_delete_from_any_root(spark, db, bronze):
    ingest(bronze(BATCH_1), "r1", "2026-06-02", db, NOW)
    authors = table(spark, "authors", db).filter("name = 'Ada'").select("id")
    assert I.delete_rows(spark, "authors", authors, db) == {"authors": 1, "paper_authors": 1}
    assert sorted(r["name"] for r in table(spark, "authors", db).collect()) == ["Ben", "Cy"]
    assert [r[:2] for r in state(spark, db)["by_author"]] == [("1v1", "Ben"), ("2v1", "Cy")]
    codes = table(spark, "categories", db).filter("code = 'cs.CL'").select("id")
    assert I.delete_rows(spark, "categories", codes, db) == {"categories": 1, "paper_categories": 2}
    assert [r["code"] for r in table(spark, "categories", db).collect()] == ["cs.LG"]
    assert table(spark, "paper_categories", db).count() == 1
    nothing = I.delete_rows(spark, "papers", codes.limit(0), db)
    assert set(nothing.values()) == {0} and nothing.keys() == {
        "papers", "paper_authors", "paper_categories", "paper_enrichments", "paper_embeddings"}
    assert table(spark, "papers", db).count() == 2


def test_new_on_day(spark, db, bronze):
    ingest(bronze(BATCH_1), "r1", "2026-06-02", db, NOW)
    papers = table(spark, "papers", db)
    assert I.new_on_day(papers, "2026-06-03").count() == 2
    assert I.new_on_day(papers, "2026-06-04").count() == 0


# Embedding job


def test_author_list_in_position_order(spark, monkeypatch):
    from scriptorium.plans import embeddings

    monkeypatch.setattr(embeddings, "_PIECE", 3)
    links = spark.createDataFrame(
        [(1, a, p) for p, a in enumerate(range(20, 0, -1), 1)] + [(2, 5, 1)],
        "paper_id long, author_id long, position int",
    )
    authors = spark.createDataFrame([(i, f"n{i}") for i in range(1, 21)], "id long, name string")
    got = {r["paper_id"]: r["authors"] for r in author_list(links, authors).collect()}
    assert got == {1: ", ".join(f"n{i}" for i in range(20, 0, -1)), 2: "n5"}


def test_embedding_job(spark, db, bronze):
    ingest(bronze([*BATCH_1, record("8v1", "Eight", authors=[])]), "r1", "2026-06-02", db, NOW)
    assert not run_embedding_job(spark, db, HashingEmbedder(8))
    landed = spark.createDataFrame([("1v1",), ("2v1",), ("8v1",)], "arxiv_id string")
    I.record_objects(spark, landed, db)
    t = all_tables(spark, db)
    inputs = embedding_inputs(t["papers"], t["paper_authors"], t["authors"]).collect()
    assert sorted(r["text"] for r in inputs) == ["One\nAda, Ben\nAbout 1v1", "Two\nCy\nAbout 2v1"]
    assert run_embedding_job(spark, db, HashingEmbedder(8), as_of=NOW)
    stored = table(spark, "paper_embeddings", db).collect()
    assert {len(r["embedding"]) for r in stored} == {8} and len(stored) == 2
    assert not run_embedding_job(spark, db, HashingEmbedder(8))

    def connect():
        return lambda texts: [[0.5] for _ in texts]

    later = "2026-06-09 00:00:00"
    assert run_embedding_job(spark, db, ClientEmbedder(connect), recompute=True, as_of=later)
    replaced = table(spark, "paper_embeddings", db).collect()
    assert [(r["embedding"], str(r["created_at"])) for r in replaced] == [([0.5], later)] * 2


# Streaming


def test_stream_file_by_file_equals_batch(spark, db, bronze, tmp_path):
    folder, checkpoint = tmp_path / "landing", str(tmp_path / "stream-checkpoint")
    folder.mkdir()

    def land(ds, records):
        (folder / f"arxiv_papers_{ds}.json").write_text(json.dumps(records))

    def run():
        ingest_stream(spark, str(folder), checkpoint, db=db).awaitTermination()

    land("2026-06-02", BATCH_1)
    run()
    assert len(state(spark, db)["papers"]) == 2
    run()  # nothing new
    assert table(spark, "ingestion_runs", db).count() == 1
    land("2026-06-03", BATCH_2)
    run()
    from scriptorium.sinks.tables import create_tables

    create_tables(spark, str(tmp_path / "batch"), f"{db}_b")
    ingest(bronze(BATCH_1, "2026-06-02"), "r1", "2026-06-02", f"{db}_b", NOW)
    ingest(bronze(BATCH_2, "2026-06-03"), "r2", "2026-06-03", f"{db}_b", NOW)
    assert state(spark, db) == state(spark, f"{db}_b")
    dates = {str(r["run_date"]) for r in table(spark, "ingestion_runs", db).collect()}
    assert dates == {"2026-06-02", "2026-06-03"}


def test_a_batch_delivered_again_is_recognised(spark, db, tmp_path):
    import shutil

    folder, checkpoint = tmp_path / "landing", tmp_path / "c"
    folder.mkdir()
    (folder / "oddly_named.json").write_text(json.dumps([*BATCH_1, record("9v1", "One")]))
    ingest_stream(spark, str(folder), str(checkpoint), db=db).awaitTermination()
    papers = [p[0] for p in state(spark, db)["papers"]]
    assert papers == ["1v1", "2v1"]  # the file names no date; nothing is lost
    assert [r["arxiv_id"] for r in table(spark, "rejected_papers", db).collect()] == ["9v1"]
    (run,) = table(spark, "ingestion_runs", db).collect()
    assert run["run_id"].startswith("stream-") and run["run_id"].endswith("-0")
    shutil.rmtree(checkpoint / "commits")  # as if it stopped before Spark's own commit
    ingest_stream(spark, str(folder), str(checkpoint), db=db).awaitTermination()
    assert table(spark, "ingestion_runs", db).count() == 1
    assert table(spark, "rejected_papers", db).count() == 1


def test_stream_with_own_handler(spark, tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()
    (folder / "arxiv_papers_2026-06-02.json").write_text(json.dumps(BATCH_2))
    seen = []
    ingest_stream(
        spark, str(folder), str(tmp_path / "c"), handler=lambda df, i: seen.append(df.count())
    ).awaitTermination()
    assert seen == [3]


def test_stream_over_the_archive(spark, db, bronze, tmp_path):
    from scriptorium.sinks.bronze import write_bronze

    lake = str(tmp_path / "lake")
    write_bronze(bronze(BATCH_1), lake, "2026-06-02")
    write_bronze(bronze([record("9v1", "Nine")]), lake, "2026-06-03")
    ingest_stream(spark, lake, str(tmp_path / "c"), db=db, array_files=False).awaitTermination()
    assert [p[0] for p in state(spark, db)["papers"]] == ["1v1", "2v1", "9v1"]
    (run,) = table(spark, "ingestion_runs", db).collect()
    assert (str(run["run_date"]), run["papers_new"]) == ("2026-06-03", 3)
