"""Data-quality checks.

Every check is a one-row DataFrame ``(check_name, violations)`` of type
(string, bigint), so that any number of them union into one job.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from scriptorium.functions.jsonx import is_broken
from scriptorium.functions.temporal import clock
from scriptorium.functions.vector import text_form


def _check(name: str, df: DataFrame, violations: Column) -> DataFrame:
    count = F.coalesce(violations.cast("bigint"), F.lit(0).cast("bigint"))
    return df.agg(count.alias("violations")).select(F.lit(name).alias("check_name"), "violations")


def _rows() -> Column:
    return F.count(F.lit(1))


def duplicate_ids(papers: DataFrame, name: str = "duplicate_papers") -> DataFrame:
    return _check(name, papers, _rows() - F.count_distinct("id"))


def null_keys(papers: DataFrame, name: str = "no_null_arxiv_ids") -> DataFrame:
    return _check(name, papers.filter(F.col("arxiv_id").isNull()), _rows())


def orphans(
    child: DataFrame,
    parent: DataFrame,
    fk: str = "paper_id",
    key: str = "id",
    name: str = "no_orphaned_paper_authors",
) -> DataFrame:
    """Child rows without a parent, null keys included."""
    return _check(name, _unmatched(child, parent, fk, key), F.sum("n"))


def _unmatched(child: DataFrame, parent: DataFrame, fk: str, key: str) -> DataFrame:
    # Children are counted per key before the join, so a hot key is one row.
    per_key = child.groupBy(fk).agg(_rows().alias("n"))
    return per_key.join(parent.select(F.col(key).alias(fk)), fk, "left_anti")


def duplicate_vectors(embeddings: DataFrame, name: str = "no_duplicate_embeddings") -> DataFrame:
    """Surplus copies by text form; a null vector counts as one, since
    ``count(distinct)`` leaves nulls out. Digests travel, not the texts."""
    digest = F.sha2(text_form(F.col("embedding")).cast("binary"), 256)
    slim = embeddings.select(digest.alias("digest"))
    return _check(name, slim, _rows() - F.count_distinct("digest"))


def embeddings_excess(
    embeddings: DataFrame, papers: DataFrame, name: str = "embeddings_not_exceed_papers"
) -> DataFrame:
    sides = embeddings.select(F.lit(1).alias("sign")).unionByName(
        papers.select(F.lit(-1).alias("sign"))
    )
    return _check(name, sides, F.greatest(F.sum("sign"), F.lit(0)))


def enrichment_empty(
    enrichments: DataFrame, name: str = "enrichment_json_parseable", parse: bool = False
) -> DataFrame:
    """Enrichments with none of the three results. ``parse`` also counts those
    whose JSON is broken, which the name promises but the plain check omits."""
    empty = (
        F.col("methods").isNull() & F.col("datasets").isNull() & F.col("summary").isNull()
    )
    if parse:
        empty = empty | is_broken(F.col("methods")) | is_broken(F.col("datasets"))
    return _check(name, enrichments.filter(empty), _rows())


def unique(df: DataFrame, key: Sequence[str], name: str) -> DataFrame:
    """Keys that occur more than once; a null in the key is never equal."""
    repeated = (
        df.na.drop(how="any", subset=list(key))
        .groupBy(*key)
        .agg(_rows().alias("n"))
        .filter(F.col("n") > 1)
    )
    return _check(name, repeated, _rows())


def not_null(df: DataFrame, column: str, name: str) -> DataFrame:
    return _check(name, df.filter(F.col(column).isNull()), _rows())


def relationships(
    child: DataFrame, parent: DataFrame, fk: str, key: str, name: str
) -> DataFrame:
    """Child rows whose non-null key has no parent."""
    return _check(name, _unmatched(child.filter(F.col(fk).isNotNull()), parent, fk, key), F.sum("n"))


def wrong_dim(embeddings: DataFrame, dim: int, name: str = "vector_dim") -> DataFrame:
    """Vectors of another length than declared; nulls are allowed."""
    return _check(name, embeddings.filter(F.size("embedding") != dim).filter(
        F.col("embedding").isNotNull()), _rows())


def freshness(
    df: DataFrame,
    column: str,
    as_of: dt.datetime | str | None = None,
    warn_hours: int = 36,
    error_hours: int = 72,
) -> DataFrame:
    """(latest, age_hours, status): pass, warn or error by the age of the
    newest row. An empty table is an error."""
    age = (F.unix_micros(clock(as_of)) - F.unix_micros(F.col("latest").cast("timestamp"))) / 3.6e9
    status = (
        F.when(F.col("age_hours") <= warn_hours, "pass")
        .when(F.col("age_hours") <= error_hours, "warn")
        .otherwise("error")
    )
    return (
        df.agg(F.max(column).alias("latest"))
        .withColumn("age_hours", age)
        .withColumn("status", status)
    )


def report(checks: Sequence[DataFrame]) -> DataFrame:
    """All checks as one DataFrame, hence one job."""
    whole = checks[0]
    for check in checks[1:]:
        whole = whole.unionByName(check)
    return whole
