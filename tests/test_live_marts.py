from __future__ import annotations

import pytest

from scriptorium.operators.changes import ConflictError
from scriptorium.plans import live_marts, marts
from scriptorium.plans.ingest import delete_papers, record_objects
from scriptorium.plans.views import staging_views
from scriptorium.sinks.logs import new_attempt, run_record
from scriptorium.sinks.tables import append, change_marks, materialize
from scriptorium.sources.catalog import all_tables, table

MARTS = (
    "authors_paper_counts", "fct_coauthor_pairs", "fct_weekly_papers_by_category",
    "fct_ingestion_health",
)


@pytest.fixture
def loaded(spark, db, tmp_path):
    live_marts.create_marts(spark, str(tmp_path / "marts"), db)
    names = spark.createDataFrame([(1, "Ada"), (2, "Ben"), (3, "Cy")], "id int, name string")
    append(names, "authors", db)
    append(spark.createDataFrame([(1, "cs.LG")], "id int, code string"), "categories", db)

    def load(day, papers=(), links=(), refresh=True):
        """One committed load of papers by id and of links (paper, author)."""
        made = spark.createDataFrame([(i,) for i in papers], "id int").selectExpr(
            "id", "concat('p', id) AS arxiv_id", "concat('Title ', id) AS title", "'x' AS abstract",
            f"timestamp'{day}' AS published_at", f"timestamp'{day}' AS ingested_at")
        mark = new_attempt()
        append(made, "papers", db, load=mark)
        append(made.selectExpr("id AS paper_id", "1 AS category_id", "true AS is_primary"),
               "paper_categories", db, load=mark)
        pairs = spark.createDataFrame(list(links), "paper_id int, author_id int")
        append(pairs.selectExpr("*", "author_id AS position"), "paper_authors", db, load=mark)
        append(run_record(made, made, f"daily-{day}", day, attempt=mark), "ingestion_runs", db)
        return live_marts.refresh(spark, db, merge_after=2) if refresh else None

    return db, load


def rows(df):
    return sorted(tuple(map(str, r)) for r in df.collect())


def equal_to_whole(spark, db):
    t = all_tables(spark, db)
    s = staging_views(t)
    whole = (
        marts.author_counts(s["stg_authors"], s["stg_paper_authors"]),
        marts.coauthor_pairs(s["stg_paper_authors"], s["stg_authors"]),
        marts.weekly_by_category(s["stg_papers"], s["stg_paper_categories"], s["stg_categories"]),
        marts.ingestion_health(s["stg_papers"], t["paper_embeddings"], t["paper_enrichments"]),
    )
    live = {name: rows(spark.table(f"{db}.{name}")) for name in MARTS}
    assert live == {name: rows(mart) for name, mart in zip(MARTS, whole)}
    return live


def test_loads_equal_a_whole_count(spark, loaded):
    db, load = loaded
    assert load("2026-06-01", (1, 2), [(1, 1), (1, 2), (2, 1)]) == "rebuilt"
    # Paper 2 gains an author: its older one makes a new pair.
    assert load("2026-06-09", (3,), [(2, 3), (3, 1), (3, 2), (3, 3)]) == "added"
    live = equal_to_whole(spark, db)
    assert live["fct_coauthor_pairs"] == [("Ada", "Ben", "2"), ("Ada", "Cy", "2"), ("Ben", "Cy", "1")]
    assert live_marts.refresh(spark, db) == "none"
    assert load("2026-06-10", (4,)) == "added"  # the third part: all are summed into one
    assert spark.table(f"{db}.mart_commits").filter("generation = 2").count() == 1
    equal_to_whole(spark, db)
    other = spark.newSession()  # the views outlive the session that made them
    assert other.table(f"{db}.stg_papers").count() == 4
    assert rows(other.table(f"{db}.fct_coauthor_pairs")) == live["fct_coauthor_pairs"]


def test_deletions_count_anew_and_new_paths_do_not(spark, loaded):
    db, load = loaded
    load("2026-06-01", (1, 2), [(1, 1), (1, 2), (2, 1), (2, 2)])
    assert record_objects(spark, spark.createDataFrame([("p1",)], "arxiv_id string"), db)
    assert change_marks(spark, "papers", db)[1] == 1
    assert load("2026-06-02", (3,), [(3, 2)]) == "added"
    delete_papers(spark, table(spark, "papers", db).filter("id = 2"), db)
    assert live_marts.refresh(spark, db) == "rebuilt"
    assert equal_to_whole(spark, db)["fct_coauthor_pairs"] == [("Ada", "Ben", "1")]
    # Rows that lose the mark of a load that was not counted yet.
    load("2026-06-03", (5,), [(5, 1)], refresh=False)
    record_objects(spark, spark.createDataFrame([("p5",)], "arxiv_id string"), db)
    assert live_marts.refresh(spark, db) == "rebuilt"
    equal_to_whole(spark, db)


def test_a_refresh_that_stops_shows_nothing(spark, loaded, monkeypatch):
    db, load = loaded
    load("2026-06-01", (1,), [(1, 1), (1, 2)])
    load("2026-06-02", (2,), [(2, 1)], refresh=False)
    before = {name: rows(spark.table(f"{db}.{name}")) for name in MARTS}
    with monkeypatch.context() as patch:
        patch.setattr(live_marts, "_commit", stopped_commit(live_marts._commit))
        with pytest.raises(ConflictError):
            live_marts.refresh(spark, db)
    assert {name: rows(spark.table(f"{db}.{name}")) for name in MARTS} == before
    assert live_marts.refresh(spark, db) == "added"
    equal_to_whole(spark, db)


def stopped_commit(commit):
    """All parts are written; then another refresh seems to have come first."""
    def run(spark, db, part, generation, removals, loads, counts, n_commits):
        commit(spark, db, part, generation, removals, loads, counts, n_commits + 1)
    return run


def test_empty_tables(spark, db, tmp_path):
    live_marts.create_marts(spark, str(tmp_path / "marts"), db)
    assert live_marts.refresh(spark, db) == "rebuilt"
    assert live_marts.refresh(spark, db) == "none"
    assert all(spark.table(f"{db}.{name}").count() == 0 for name in MARTS)


def test_a_model_table_moves_to_new_files(spark, db):
    materialize(spark.range(3), "numbers", True, db)
    reader = spark.table(f"{db}.numbers")
    materialize(reader.filter("id > 0"), "numbers", True, db)  # reads what it replaces
    assert spark.table(f"{db}.numbers").count() == 2
    materialize(spark.range(1).selectExpr("id AS other"), "numbers", True, db)
    assert spark.table(f"{db}.numbers").columns == ["other"]
