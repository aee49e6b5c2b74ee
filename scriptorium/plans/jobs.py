"""The scheduled jobs: daily ingest, model build, quality run."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from scriptorium.operators.quality import freshness
from scriptorium.operators.suite import evaluate, model_rules, standard_rules
from scriptorium.operators.topics import select_topics
from scriptorium.plans import marts
from scriptorium.plans.ingest import IngestOptions, ingest
from scriptorium.plans.views import staging_views
from scriptorium.schemas import BRONZE
from scriptorium.sinks.bronze import write_bronze
from scriptorium.sinks.logs import run_checks
from scriptorium.sinks.tables import materialize
from scriptorium.sources.bronze import read_bronze
from scriptorium.sources.catalog import all_tables
from scriptorium.sources.feed import read_feed


def run_day(
    spark: SparkSession,
    feed: str,
    lake: str,
    ds: str,
    db: str = "default",
    as_of: dt.datetime | str | None = None,
    options: IngestOptions = IngestOptions(),
    topics: bool = True,
) -> DataFrame:
    """One run date: landed feed files to the archive, then what the archive
    holds to the tables. Returns the rejected papers.

    With ``topics`` only the newest papers of the topic groups are taken; a
    paper in two groups arrives twice and the cleaning keeps it once.
    """
    raw = read_feed(spark, feed)
    if topics:
        raw = select_topics(raw).select(*BRONZE.fieldNames())
    write_bronze(raw, lake, ds)
    archived = read_bronze(spark, lake, ds, ds)
    return ingest(archived, f"daily-{ds}", ds, db, as_of, options)


def build_models(spark: SparkSession, db: str = "default", as_tables: bool = False) -> list[str]:
    """Rebuild the staging views and the four marts; returns their names.

    Staging models are views. Marts are views too unless asked for as tables;
    then they are written unsorted and in parallel, and read in any order. All
    views end with the session; ``plans.live_marts`` keeps lasting ones, with
    marts that grow by load.
    """
    t = all_tables(spark, db)
    stg = staging_views(t)
    for name, view in stg.items():
        materialize(view, name)
    built = {
        "authors_paper_counts": marts.author_counts(stg["stg_authors"], stg["stg_paper_authors"]),
        "fct_coauthor_pairs": marts.coauthor_pairs(stg["stg_paper_authors"], stg["stg_authors"]),
        "fct_weekly_papers_by_category": marts.weekly_by_category(
            stg["stg_papers"], stg["stg_paper_categories"], stg["stg_categories"]
        ),
        "fct_ingestion_health": marts.ingestion_health(
            stg["stg_papers"], t["paper_embeddings"], t["paper_enrichments"]
        ),
    }
    for name, mart in built.items():
        materialize(mart, name, as_tables, db)
    return [*stg, *built]


def run_quality(
    spark: SparkSession,
    db: str = "default",
    as_of: dt.datetime | str | None = None,
    fail: bool = True,
    with_model_checks: bool = False,
) -> DataFrame:
    """The daily checks as one job that scans each table once, logged, failing
    together at the end."""
    rules = standard_rules() + (model_rules() if with_model_checks else [])
    return run_checks([evaluate(rules, all_tables(spark, db))], db, as_of, fail)


def source_freshness(
    spark: SparkSession, db: str = "default", as_of: dt.datetime | str | None = None
) -> str:
    """pass, warn (over 36 h) or error (over 72 h) for the papers table."""
    papers = all_tables(spark, db)["papers"]
    return freshness(papers, "ingested_at", as_of).select(F.col("status")).first()[0]
