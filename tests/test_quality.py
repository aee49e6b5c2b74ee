from __future__ import annotations

import pytest

from scriptorium.operators import quality, suite
from scriptorium.sinks.logs import QualityError, run_checks
from scriptorium.sources.catalog import all_tables


def count(check):
    (row,) = check.collect()
    return row["violations"]


def test_unique_leaves_nulls_out(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (2, None)], "k long, s string")
    assert count(quality.unique(df, ["k"], "u")) == 2
    assert count(quality.unique(df, ["s"], "u")) == 1
    assert count(quality.unique(df, ["k", "s"], "u")) == 1
    assert count(quality.not_null(df, "s", "n")) == 2


def test_orphans_count_nulls_and_relationships_do_not(spark):
    child = spark.createDataFrame([(1,), (2,), (2,), (None,)], "paper_id long")
    parent = spark.createDataFrame([(1,)], "id long")
    assert count(quality.orphans(child, parent)) == 3
    assert count(quality.relationships(child, parent, "paper_id", "id", "r")) == 2


def test_vector_checks(spark):
    df = spark.sql(
        """SELECT * FROM VALUES (array(float(0))), (array(float('-0.0'))), (array(float(0))),
        (cast(null AS array<float>)), (array(float(1), float(2))) AS v(embedding)"""
    )
    # One true copy by text form, one null; -0.0 is its own text.
    assert count(quality.duplicate_vectors(df)) == 2
    assert count(quality.wrong_dim(df, 1)) == 1


def test_excess_is_never_negative(spark):
    few, many = spark.range(2), spark.range(5)
    assert count(quality.embeddings_excess(few, many)) == 0
    assert count(quality.embeddings_excess(many, few)) == 3
    assert count(quality.embeddings_excess(spark.range(0), spark.range(0))) == 0


def test_enrichments(spark):
    df = spark.createDataFrame(
        [(None, None, None), ("s", None, None), (None, "[]", None), ("s", "bad", "[]")],
        "summary string, methods string, datasets string",
    )
    assert count(quality.enrichment_empty(df)) == 1
    assert count(quality.enrichment_empty(df, parse=True)) == 2


@pytest.mark.parametrize(
    ("hours", "status"), [(35, "pass"), (36, "pass"), (37, "warn"), (72, "warn"), (73, "error")]
)
def test_freshness(spark, hours, status):
    df = spark.sql(f"SELECT timestamp'2024-01-10 00:00:00' - INTERVAL {hours} HOUR AS t")
    row = quality.freshness(df, "t", "2024-01-10 00:00:00").first()
    assert (row["age_hours"], row["status"]) == (hours, status)


def test_freshness_of_nothing_is_an_error(spark):
    df = spark.createDataFrame([], "t timestamp")
    assert quality.freshness(df, "t", "2024-01-10 00:00:00").first()["status"] == "error"


def test_runner_logs_all_and_names_all_failures(spark, db):
    parent = spark.createDataFrame([(1,)], "id long")
    child = spark.createDataFrame([(2,), (2,)], "paper_id long")
    checks = [
        quality.not_null(parent, "id", "fine"),
        quality.orphans(child, parent, name="orphaned"),
        quality.unique(child, ["paper_id"], "repeated"),
    ]
    with pytest.raises(QualityError, match="orphaned: 2; repeated: 1"):
        run_checks(checks, db, as_of="2024-01-01 00:00:00")
    log = all_tables(spark, db)["quality_checks"].collect()
    assert sorted((r["check_name"], r["violations"]) for r in log) == [
        ("fine", 0),
        ("orphaned", 2),
        ("repeated", 1),
    ]
    assert run_checks(checks, db, fail=False).count() == 3
    assert all_tables(spark, db)["quality_checks"].count() == 6


def test_rules_count_as_the_single_checks_do(spark):
    papers = spark.createDataFrame(
        [(1, "a"), (1, "a"), (2, None), (None, "b"), (None, "b"), (3, "c")], "id long, arxiv_id string")
    links = spark.createDataFrame(
        [(1, 1), (9, 1), (9, 2), (None, 2), (3, None)], "paper_id long, author_id long")
    vectors = spark.sql(
        """SELECT * FROM VALUES (array(float(0))), (array(float('-0.0'))), (array(float(0))),
        (cast(null AS array<float>)), (array(float(1))), (array(float(1))), (array(float(1))) AS v(embedding)"""
    )
    done = spark.createDataFrame(
        [(None, None, None), ("s", None, None)], "summary string, methods string, datasets string")
    authors, codes = spark.range(2), spark.range(0)
    tables = {"papers": papers, "paper_authors": links, "paper_embeddings": vectors,
              "paper_enrichments": done, "authors": authors, "categories": codes}
    got = {r["check_name"]: r["violations"] for r in
           suite.evaluate(suite.standard_rules() + suite.model_rules(), tables).collect()}
    single = [
        quality.duplicate_ids(papers), quality.null_keys(papers), quality.orphans(links, papers),
        quality.duplicate_vectors(vectors), quality.embeddings_excess(vectors, papers),
        quality.enrichment_empty(done),
        quality.unique(papers, ["id"], "unique_stg_papers_paper_id"),
        quality.not_null(papers, "id", "not_null_stg_papers_paper_id"),
        quality.unique(papers, ["arxiv_id"], "unique_stg_papers_arxiv_id"),
        quality.relationships(links, papers, "paper_id", "id", "relationships_stg_paper_authors_paper_id"),
        quality.relationships(links, authors, "author_id", "id", "relationships_stg_paper_authors_author_id"),
        quality.not_null(links, "author_id", "not_null_stg_paper_authors_author_id"),
    ]
    want = {r["check_name"]: r["violations"] for r in quality.report(single).collect()}
    assert len(got) == 18 and {k: got[k] for k in want} == want
    assert want["no_orphaned_paper_authors"] == 3 and want["duplicate_papers"] == 3
    empty = {name: df.limit(0) for name, df in tables.items()}
    rows = suite.evaluate(suite.standard_rules() + suite.model_rules(), empty).collect()
    assert len(rows) == 18 and all(r["violations"] == 0 for r in rows)


def test_each_table_is_scanned_once(spark, tmp_path):
    schemas = {
        "papers": "id long, arxiv_id string", "paper_authors": "paper_id long, author_id long",
        "paper_embeddings": "embedding array<float>", "authors": "id long", "categories": "id long",
        "paper_enrichments": "summary string, methods string, datasets string"}
    tables = {}
    for name, schema in schemas.items():
        spark.createDataFrame([], schema).write.parquet(str(tmp_path / name))
        tables[name] = spark.read.parquet(str(tmp_path / name))
    whole = suite.evaluate(suite.standard_rules() + suite.model_rules(), tables)
    plan = whole._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == len(tables)
