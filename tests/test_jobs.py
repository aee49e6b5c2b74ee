from __future__ import annotations

import pytest

from scriptorium.plans import jobs
from scriptorium.sinks.logs import QualityError
from scriptorium.sinks.tables import append
from scriptorium.sources.catalog import all_tables, list_tables, table

ENTRY = """<entry><id>http://host/abs/{id}</id><title>{title}</title><summary>{text}</summary>
<published>{day}T10:00:00Z</published><updated>{day}T10:00:00Z</updated>
<link title="pdf" href="http://host/pdf/{id}" rel="related"/>{authors}
<arxiv:primary_category term="{code}"/><category term="{code}"/><category term="cs.CV"/></entry>"""


def feed(*entries):
    body = "".join(
        ENTRY.format(
            id=i, title=t, text=x, code=c, day=d,
            authors="".join(f"<author><name>{a}</name></author>" for a in names),
        )
        for i, t, x, c, d, names in entries
    )
    return (
        '<feed xmlns="http://www.w3.org/2005/Atom" xmlns:arxiv="http://host/schemas/atom">'
        f"{body}</feed>"
    )


@pytest.fixture
def ingested(spark, db, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / "feed.xml").write_text(
        feed(
            ("1v1", "An LLM paper", "text", "cs.CL", "2026-06-01", ["Ada", "Ben"]),
            ("2v1", "Vision", "uses an llm", "cs.CV", "2026-06-02", ["Ben", "Ada"]),
            ("3v1", "Off topic", "none", "cs.CL", "2026-06-02", ["Cy"]),
            ("4v1", "LLM physics", "text", "hep-th", "2026-06-02", ["Cy"]),
        )
    )
    jobs.run_day(spark, str(landing), str(tmp_path / "lake"), "2026-06-02", db,
                 "2026-06-03 00:00:00")
    return db


def test_day_takes_the_topic_groups(spark, ingested):
    # 4v1 carries cs.CV as a second category, so it belongs to a group too.
    ids = sorted(r["arxiv_id"] for r in table(spark, "papers", ingested).collect())
    assert ids == ["1v1", "2v1", "4v1"]
    (run,) = table(spark, "ingestion_runs", ingested).collect()
    assert (run["run_id"], run["papers_new"]) == ("daily-2026-06-02", 3)


@pytest.mark.parametrize("as_tables", [False, True])
def test_models(spark, ingested, as_tables):
    names = jobs.build_models(spark, ingested, as_tables)
    assert len(names) == 9
    pairs = table(spark, "fct_coauthor_pairs", ingested).collect()
    assert [tuple(r) for r in pairs] == [("Ada", "Ben", 2)]
    counts = {r["name"]: r["n_papers"] for r in
              table(spark, "authors_paper_counts", ingested).collect()}
    assert counts == {"Ada": 2, "Ben": 2, "Cy": 1}
    weekly = {tuple(map(str, r)) for r in
              table(spark, "fct_weekly_papers_by_category", ingested).collect()}
    assert ("2026-06-01", "cs.CV", "3") in weekly
    (health,) = table(spark, "fct_ingestion_health", ingested).collect()
    assert tuple(map(str, health)) == ("2026-06-03", "3", "0", "0")
    assert ("fct_coauthor_pairs" in list_tables(spark, ingested)) == as_tables


def test_quality_and_freshness(spark, ingested):
    report = jobs.run_quality(spark, ingested, with_model_checks=True)
    assert report.count() == 18 and report.filter("violations > 0").count() == 0
    assert jobs.source_freshness(spark, ingested, "2026-06-04 12:00:00") == "pass"
    assert jobs.source_freshness(spark, ingested, "2026-06-05 00:00:00") == "warn"
    assert jobs.source_freshness(spark, ingested, "2026-06-07 00:00:00") == "error"
    append(table(spark, "papers", ingested).limit(1), "papers", ingested)
    with pytest.raises(QualityError, match="duplicate_papers: 1"):
        jobs.run_quality(spark, ingested)
    assert all_tables(spark, ingested)["quality_checks"].count() == 24


def test_marts_in_reading_order(spark):
    from scriptorium.plans.marts import sorted_mart

    counts = spark.createDataFrame([("b", 1), ("c", 5), ("a", 1)], "name string, n_papers long")
    assert [r["name"] for r in sorted_mart(counts, "author_counts").collect()] == ["c", "a", "b"]
    days = spark.sql("SELECT * FROM VALUES (null), (date'2024-01-02'), (date'2024-01-01') AS v(day)")
    assert [str(r["day"]) for r in sorted_mart(days, "ingestion_health").collect()] == [
        "2024-01-01",
        "2024-01-02",
        "None",
    ]


def test_a_day_without_papers(spark, db, tmp_path):
    landing = tmp_path / "none"
    landing.mkdir()
    (landing / "feed.xml").write_text(feed())
    rejected = jobs.run_day(spark, str(landing), str(tmp_path / "lake"), "2026-06-05", db)
    assert rejected.count() == 0
    (run,) = table(spark, "ingestion_runs", db).collect()
    assert (run["papers_fetched"], run["papers_new"], run["status"]) == (0, 0, "success")
