"""Append-only logs: ingestion runs and quality checks."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, functions as F

from scriptorium.functions.temporal import clock
from scriptorium.operators.quality import report
from scriptorium.sinks.tables import append
from scriptorium.sources.catalog import table


def new_attempt() -> int:
    """A random id of 63 bits."""
    return uuid.uuid4().int >> 65


def run_record(
    staging: DataFrame,
    inserted: DataFrame,
    run_id: str,
    run_date: str,
    category_code: str = "arxiv_batch",
    status: str = "success",
    error_message: str | None = None,
    started_at: dt.datetime | str | None = None,
    finished_at: dt.datetime | str | None = None,
    attempt: int | None = None,
) -> DataFrame:
    """One run-log row; both counts come out of one aggregation. ``attempt``
    is its id, by default a new one; rows of the load with that id are visible
    from a success on."""
    kinds = staging.select(F.lit(1).alias("fetched"), F.lit(0).alias("new")).unionByName(
        inserted.select(F.lit(0).alias("fetched"), F.lit(1).alias("new"))
    )
    return kinds.agg(
        F.coalesce(F.sum("fetched"), F.lit(0)).cast("int").alias("papers_fetched"),
        F.coalesce(F.sum("new"), F.lit(0)).cast("int").alias("papers_new"),
    ).select(
        F.lit(new_attempt() if attempt is None else attempt).cast("bigint").alias("id"),
        F.lit(run_id).alias("run_id"),
        F.lit(run_date).cast("date").alias("run_date"),
        F.lit(category_code).alias("category_code"),
        "papers_fetched",
        "papers_new",
        F.lit(status).alias("status"),
        F.lit(error_message).cast("string").alias("error_message"),
        clock(started_at).alias("started_at"),
        clock(finished_at).alias("finished_at"),
    )


def failed_run(
    spark, run_id: str, run_date: str, error: Exception,
    started_at: dt.datetime | str | None = None, attempt: int | None = None,
) -> DataFrame:
    empty = spark.range(0)
    return run_record(
        empty, empty, run_id, run_date, status="failed", error_message=str(error),
        started_at=started_at, attempt=attempt,
    )


def succeeded(spark, run_id: str, db: str = "default") -> bool:
    """Whether some attempt of a run was committed."""
    runs = table(spark, "ingestion_runs", db)
    return not runs.filter((F.col("run_id") == run_id) & (F.col("status") == "success")).isEmpty()


class QualityError(ValueError):
    """Some checks found violations."""


def run_checks(
    checks: list[DataFrame],
    db: str = "default",
    as_of: dt.datetime | str | None = None,
    fail: bool = True,
) -> DataFrame:
    """Run all checks as one job, log every result, then raise for the failing
    ones together. The report has one row per check."""
    whole = report(checks)
    spark = whole.sparkSession
    rows = whole.collect()  # one row per check
    done = spark.createDataFrame(rows, whole.schema)
    append(done.withColumn("run_at", clock(as_of)), "quality_checks", db)
    failing = sorted(f"{r['check_name']}: {r['violations']}" for r in rows if r["violations"])
    if fail and failing:
        raise QualityError("quality checks failed: " + "; ".join(failing))
    return done
