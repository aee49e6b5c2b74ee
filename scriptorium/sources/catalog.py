"""Tables by name, and the listing of them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from scriptorium.schemas import BUCKET, LOAD, TABLES


def table(
    spark: SparkSession, name: str, db: str = "default", load: int | None = None
) -> DataFrame:
    """A base table, a materialised model or a view, by name. Rows of a load
    that is not committed are seen by that load only.

    A session remembers the files of a table; the refresh makes it see what
    another one, such as a streaming query's, has written since.
    """
    full = f"{db}.{name}"
    if not spark.catalog.tableExists(full):
        return spark.table(name)
    spark.catalog.refreshTable(full)
    return _visible(spark.table(full), db, load).drop(BUCKET)


def committed_loads(spark: SparkSession, db: str = "default") -> DataFrame:
    """The loads whose last write, the success in the run log, was made."""
    full = f"{db}.ingestion_runs"
    spark.catalog.refreshTable(full)
    return spark.table(full).filter("status = 'success'").select(F.col("id").alias(LOAD))


def _visible(rows: DataFrame, db: str, load: int | None = None) -> DataFrame:
    if LOAD not in rows.columns:
        return rows
    done = committed_loads(rows.sparkSession, db).withColumn("done", F.lit(True))
    seen = F.col(LOAD).isNull() | F.col("done") | F.coalesce(F.col(LOAD) == F.lit(load), F.lit(False))
    columns = [c for c in rows.columns if c != LOAD]
    return rows.join(done, LOAD, "left").filter(seen).select(*columns)


def table_buckets(
    spark: SparkSession, name: str, buckets: Sequence[int], db: str = "default",
    load: int | None = None,
) -> DataFrame:
    """The rows of some id ranges of a base table; other ranges are pruned."""
    full = f"{db}.{name}"
    spark.catalog.refreshTable(full)
    rows = spark.table(full).filter(F.col(BUCKET).isin(list(buckets)))
    return _visible(rows, db, load).drop(BUCKET)


def all_tables(
    spark: SparkSession, db: str = "default", load: int | None = None
) -> dict[str, DataFrame]:
    return {name: table(spark, name, db, load) for name in TABLES}


def list_tables(spark: SparkSession, db: str = "default") -> list[str]:
    """Names of the base tables of a database, sorted; views are left out."""
    return sorted(
        t.name
        for t in spark.catalog.listTables(db)
        if not t.isTemporary and t.tableType in ("MANAGED", "EXTERNAL")
    )


def describe_tables(spark: SparkSession, db: str = "default") -> str:
    names = list_tables(spark, db)
    if not names:
        return "no tables found"
    return f"{len(names)} tables: {', '.join(names)}"
