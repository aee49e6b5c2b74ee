"""Raw records to staging to the normalised tables, all or nothing.

The rows of a batch carry the id of its attempt and are visible to others only
when the run log holds that id as a success, which is the batch's last write. A
batch that stops earlier shows nothing; run again, it starts afresh under a new
id. Every step inserts only what is absent, so a batch that is run again after
a success changes nothing.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from scriptorium.functions.temporal import clock
from scriptorium.functions.text import object_path
from scriptorium.operators.changes import (
    ConflictError,
    insert_absent,
    insert_absent_links,
    keep_latest,
    referring,
    split_conflicts,
    update_from,
    without_parents,
)
from scriptorium.operators.clean import clean, drop_incomplete
from scriptorium.operators.ids import assign_ids, last_id
from scriptorium.operators.links import author_links, category_links, unnest
from scriptorium.operators.pruning import key_intervals, within
from scriptorium.schemas import TABLES, referred_keys, referrers
from scriptorium.session import scratch_path
from scriptorium.sinks.logs import failed_run, new_attempt, run_record
from scriptorium.sinks.tables import append, change_rows, mark_removal, publish, touched_buckets, update_rows
from scriptorium.sources.bronze import BRONZE_ORDER
from scriptorium.sources.catalog import all_tables, committed_loads, table, table_buckets


@dataclass(frozen=True)
class IngestOptions:
    """``mode`` says what a paper does that lacks a required value or has the
    title of another: ``quarantine`` sets it aside, ``strict`` stops before
    anything is written to the normalised tables.
    ``now_as_updated`` stamps ``updated_at`` with the clock instead of the
    value the source gave."""

    mode: str = "quarantine"
    now_as_updated: bool = False


def stage(raw: DataFrame, db: str = "default") -> DataFrame:
    """Clean raw records and rebuild the staging table from them."""
    order = [F.col(c) for c in BRONZE_ORDER if c in raw.columns]
    publish(clean(raw, order=order), "staging_papers", db)
    return table(raw.sparkSession, "staging_papers", db)


def staged_papers(
    staging: DataFrame, as_of: dt.datetime | str | None, now_as_updated: bool = False
) -> DataFrame:
    """Staged rows in the shape of the papers table, without ids."""
    now = clock(as_of)
    updated = now if now_as_updated else F.coalesce(F.col("updated_at").cast("timestamp"), now)
    return staging.select(
        "arxiv_id",
        "title",
        "abstract",
        F.col("published_at").cast("timestamp").alias("published_at"),
        updated.alias("updated_at"),
        "pdf_url",
        F.lit(None).cast("string").alias("pdf_object_path"),
        now.alias("ingested_at"),
    )


def insert_papers(
    spark: SparkSession, staging: DataFrame, db: str, as_of, options: IngestOptions,
    load: int | None = None,
) -> DataFrame:
    """Append the papers that are not stored yet; returns ``(arxiv_id, reason)``
    of the rejected ones.

    The new rows are written to the shared folder once: conflicts, ids and the
    append all read them there instead of comparing with the stored papers
    again each time.
    """
    papers = table(spark, "papers", db, load)
    staged = staged_papers(staging, as_of, options.now_as_updated)
    # Feed ids grow with time: stored row groups of other times are skipped.
    near = papers.filter(within(F.col("arxiv_id"), key_intervals(staged, "arxiv_id")))
    fresh = insert_absent(near, staged, ["arxiv_id"], [F.col("published_at"), F.col("title")])
    path = scratch_path(spark, "new-papers")
    fresh.write.parquet(path)
    fresh = spark.read.schema(fresh.schema).parquet(path)
    required = [c for c in TABLES["papers"].required if c != "id"]
    complete = drop_incomplete(fresh, required)
    if options.mode == "strict":
        lacking = fresh.join(complete.select("arxiv_id"), "arxiv_id", "left_anti")
        if not lacking.isEmpty():
            raise ConflictError(f"no value in a required column, as in: {lacking.first()}")
    accepted, _ = split_conflicts(
        papers, complete, "title", "arxiv_id", [F.col("arxiv_id")], options.mode
    )
    append(assign_ids(accepted, "arxiv_id", last_id(papers)), "papers", db, as_of, load)
    stored = table(spark, "papers", db, load).select("arxiv_id")
    lacks = F.concat_ws(", ", *[F.when(F.col(c).isNull(), F.lit(c)) for c in required])
    reason = F.when(lacks != "", F.concat(F.lit("no value in "), lacks)).otherwise(TITLE_TAKEN)
    return fresh.join(stored, "arxiv_id", "left_anti").select("arxiv_id", reason.alias("reason"))


TITLE_TAKEN = "title of another paper"


def insert_names(
    spark: SparkSession, values: DataFrame, name: str, db: str, load: int | None = None
) -> None:
    """Append absent values of a one-column dimension with new ids. The values
    are read twice, so they are taken out of the records once."""
    existing = table(spark, name, db, load)
    key = values.columns[0]
    values = _written(values.distinct(), f"new-{name}")
    absent = insert_absent(existing, values, [key])
    append(assign_ids(absent, key, last_id(existing)), name, db, load=load)


def distribute(
    spark: SparkSession,
    staging: DataFrame,
    db: str = "default",
    as_of: dt.datetime | str | None = None,
    options: IngestOptions = IngestOptions(),
    run_id: str = "",
    load: int | None = None,
) -> DataFrame:
    """Staged rows into papers, authors, categories and the two link tables,
    or, whole and with a reason, into the rejected papers, which it returns."""
    reasons = insert_papers(spark, staging, db, as_of, options, load)
    path = scratch_path(spark, "rejected")
    staging.join(reasons, "arxiv_id").select(
        F.lit(run_id).alias("run_id"), "reason", *staging.columns).write.parquet(path)
    rejected = spark.read.parquet(path)
    append(rejected, "rejected_papers", db, as_of, load)

    # Names and links of papers that are stored, now or since before.
    papers = table(spark, "papers", db, load).select("arxiv_id", "id")
    kept = staging.join(papers.select("arxiv_id"), "arxiv_id", "left_semi")
    insert_names(spark, unnest(kept.select("authors"), "authors", "name"), "authors", db, load)
    codes = unnest(kept.select("all_categories"), "all_categories", "code")
    insert_names(spark, codes, "categories", db, load)

    t = all_tables(spark, db, load)
    # Links are compared with those of the same id ranges only.
    seen = staging.select("arxiv_id").join(t["papers"].select("arxiv_id", "id"), "arxiv_id")
    buckets = touched_buckets(seen.select("id"))
    append(
        insert_absent_links(
            table_buckets(spark, "paper_authors", buckets, db, load),
            author_links(staging, t["papers"], t["authors"]),
            ["paper_id", "author_id"],
            least="position",
        ),
        "paper_authors",
        db,
        load=load,
    )
    append(
        insert_absent(
            table_buckets(spark, "paper_categories", buckets, db, load),
            category_links(staging, t["papers"], t["categories"]),
            ["paper_id", "category_id"],
        ),
        "paper_categories",
        db,
        load=load,
    )
    return rejected


def ingest(
    raw: DataFrame,
    run_id: str,
    run_date: str,
    db: str = "default",
    as_of: dt.datetime | str | None = None,
    options: IngestOptions = IngestOptions(),
) -> DataFrame:
    """Stage, distribute and log one batch; returns the rejected papers.

    A failure is logged with its message and raised again; nothing of the
    batch shows then. So does a batch during which another one was committed:
    both would have dealt the same new ids.
    """
    spark = raw.sparkSession
    as_of = as_of or dt.datetime.now(dt.timezone.utc)
    load = new_attempt()
    try:
        before = committed_loads(spark, db).count()
        staging = stage(raw, db)
        known = last_id(table(spark, "papers", db).select("id"))
        if staging.isEmpty():
            rejected = table(spark, "rejected_papers", db).limit(0)
        else:
            rejected = distribute(spark, staging, db, as_of, options, run_id, load)
        inserted = table(spark, "papers", db, load).filter(F.col("id") > known)
        record = run_record(staging, inserted, run_id, run_date, started_at=as_of, attempt=load)
        if committed_loads(spark, db).count() != before:
            raise ConflictError("another batch was committed meanwhile; run this one again")
        append(record, "ingestion_runs", db)
        return rejected
    except Exception as error:
        failure = failed_run(spark, run_id, run_date, error, as_of, load)
        append(failure, "ingestion_runs", db)
        raise


def pending_objects(papers: DataFrame) -> DataFrame:
    """(arxiv_id, pdf_url) of papers without a stored object."""
    return papers.filter(F.col("pdf_object_path").isNull()).select("arxiv_id", "pdf_url")


def landed_paths(inventory: DataFrame) -> DataFrame:
    """(arxiv_id, pdf_object_path), one row per paper with a landed object."""
    return inventory.select(
        "arxiv_id", object_path(F.col("arxiv_id")).alias("pdf_object_path")
    ).dropDuplicates(["arxiv_id"])


def with_object_paths(papers: DataFrame, inventory: DataFrame) -> DataFrame:
    """Papers with the path set for every object that has landed."""
    return update_from(papers, landed_paths(inventory), "arxiv_id", "pdf_object_path")


def record_objects(spark: SparkSession, inventory: DataFrame, db: str = "default") -> bool:
    """Store the paths of landed objects; False when no paper waits for one of
    them. Only the id ranges of papers that get a path are rewritten, found in
    row groups that can hold a landed id."""
    landed = _written(landed_paths(inventory), "landed")
    waiting = F.col("pdf_object_path").isNull()
    return bool(update_rows(
        landed, "papers", "arxiv_id", "pdf_object_path", db, of=waiting))


def delete_rows(
    spark: SparkSession, root: str, deleted: DataFrame, db: str = "default"
) -> dict[str, int]:
    """Delete the rows of ``root`` with the given ids and every row that refers
    to a deleted one, at any depth; returns the number of rows per table.

    All deleted rows are found before anything is written. Then children go
    first and the root last, so a deletion that stops midway leaves no row
    whose parent is gone, and can be run again. Of tables kept by ranges of
    paper ids only the ranges with deleted rows are rewritten.
    """
    gone = _written(deleted.select(F.col(deleted.columns[0]).alias("id")).distinct(), "deleted-ids")
    tables = {name: table(spark, name, db) for name in referrers(root)}
    dead, counts = {}, {}
    for name in referrers(root):
        spec = TABLES[name]
        wanted = sorted({*referred_keys(name), spec.id_col or "", *spec.unique[0]} - {""})
        here = tables[name]
        rows = here.join(gone, "id", "left_semi") if name == root else referring(here, name, dead)
        dead[name] = _written(rows.select(*wanted).distinct(), f"deleted-{name}")
        counts[name] = dead[name].count()
    for name in reversed(referrers(root)):
        if not counts[name]:
            continue
        spec = TABLES[name]
        parents = {p: rows for p, rows in dead.items() if p != name}

        def kept(rows: DataFrame, name=name, parents=parents) -> DataFrame:
            return rows.join(gone, "id", "left_anti") if name == root else without_parents(rows, name, parents)

        if spec.id_col is None:
            publish(kept(tables[name]), name, db)
        else:
            mark_removal(spark, name, db)
            change_rows(spark, name, dead[name].select(spec.id_col), kept, db)
            mark_removal(spark, name, db)
    return counts


def delete_papers(spark: SparkSession, deleted: DataFrame, db: str = "default") -> None:
    """Delete the papers with the given ids and every row that refers to one."""
    delete_rows(spark, "papers", deleted.select("id"), db)


def delete_older_titles(spark: SparkSession, db: str = "default") -> None:
    """Of papers with one title keep the one with the largest id."""
    papers = table(spark, "papers", db).select("id", "title")
    delete_papers(spark, papers.join(keep_latest(papers, "title"), "id", "left_anti"), db)


def new_on_day(papers: DataFrame, day: str) -> DataFrame:
    """Papers ingested on the given date."""
    return papers.filter(F.to_date("ingested_at") == F.lit(day).cast("date"))


def _written(rows: DataFrame, label: str) -> DataFrame:
    path = scratch_path(rows.sparkSession, label)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)
