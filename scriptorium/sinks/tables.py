"""Base tables: external Parquet tables of the Spark catalog.

Inserts append. Whatever changes or removes rows writes new files first and
then moves the location of the table, or of the id ranges it touched, to them:
readers see the old rows or the new ones, untouched ranges are not rewritten,
and a plan never overwrites the files it reads.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from scriptorium.functions.temporal import clock
from scriptorium.operators.changes import update_from, upsert
from scriptorium.operators.pruning import key_intervals, within
from scriptorium.operators.skew import first_per_key
from scriptorium.schemas import BUCKET, IDS_PER_BUCKET, LOAD, NOW, TABLES
from scriptorium.sources.bronze import path_exists
from scriptorium.sources.catalog import committed_loads, table, table_buckets


def create_tables(spark: SparkSession, root: str, db: str = "default") -> None:
    """Create the absent tables, empty, under ``root``. Idempotent."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}")
    for name, spec in TABLES.items():
        # Parquet tables enforce no NOT NULL; the checks do.
        columns = [f"{f.name} {f.dataType.simpleString()}" for f in spec.schema.fields]
        if spec.loaded:
            columns.append(f"{LOAD} bigint")
        layout = ""
        if spec.id_col is not None:
            columns.append(f"{BUCKET} bigint")
            layout = f"PARTITIONED BY ({BUCKET})"
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {db}.{name} ({', '.join(columns)}) USING parquet "
            f"{layout} LOCATION '{_fresh_path(root, name, 'base')}'"
        )


def bucket_of(ids: Column) -> Column:
    return F.coalesce(F.floor(ids / IDS_PER_BUCKET), F.lit(0)).cast("bigint")


def conform(df: DataFrame, name: str, as_of: dt.datetime | str | None = None) -> DataFrame:
    """The table's columns, in order and type, with defaults filled in."""
    spec = TABLES[name]
    columns = []
    for column in spec.schema.fields:
        value = F.col(column.name) if column.name in df.columns else F.lit(None)
        if column.name in spec.defaults:
            default = spec.defaults[column.name]
            value = F.coalesce(value, clock(as_of) if default == NOW else F.lit(default))
        columns.append(value.cast(column.dataType).alias(column.name))
    return df.select(*columns)


def append(
    df: DataFrame, name: str, db: str = "default", as_of: dt.datetime | str | None = None,
    load: int | None = None,
) -> None:
    """Add rows; those present are never touched. With a load they become
    visible when the run log records its success."""
    rows = conform(df, name, as_of)
    if TABLES[name].loaded:
        rows = rows.withColumn(LOAD, F.lit(load).cast("bigint"))
    _bucketed(rows, name).write.insertInto(f"{db}.{name}")


def publish(
    df: DataFrame,
    name: str,
    db: str = "default",
    as_of: dt.datetime | str | None = None,
    cluster_by: str | None = None,
) -> None:
    """Replace all rows of a table."""
    spark, full = df.sparkSession, f"{db}.{name}"
    mark_removal(spark, name, db)
    if TABLES[name].id_col is not None:
        new = df.select(bucket_of(F.col(TABLES[name].id_col)).alias(BUCKET)).distinct()
        buckets = {row[0] for row in new.collect()} | set(_stored_buckets(spark, full))
        replace_buckets(df, sorted(buckets), name, db, as_of, cluster_by)
        mark_removal(spark, name, db)
        return
    target = _fresh_path(_root_of(spark, full), name, "snapshot")
    conform(df, name, as_of).write.parquet(target)
    spark.sql(f"ALTER TABLE {full} SET LOCATION '{target}'")
    spark.catalog.refreshTable(full)
    mark_removal(spark, name, db)


def replace_buckets(
    rows: DataFrame,
    buckets: Sequence[int],
    name: str,
    db: str = "default",
    as_of: dt.datetime | str | None = None,
    cluster_by: str | None = None,
) -> None:
    """Make ``rows`` the whole content of the given id ranges.

    ``cluster_by`` orders each file by another column than the table's own.
    The rows belong to no load any more, so only visible ones may be
    given. A range that is left without rows keeps an empty folder: dropping
    it would let a later insert find the old files again.
    """
    spark, full = rows.sparkSession, f"{db}.{name}"
    target = _fresh_path(_root_of(spark, full), name, "change")
    written = _bucketed(conform(rows, name, as_of), name, cluster_by)
    written.write.partitionBy(BUCKET).parquet(target)
    if TABLES[name].loaded:
        _mark(spark, full, FOLDED, committed_loads(spark, db).count())
    stored, added = set(_stored_buckets(spark, full)), []
    for bucket in buckets:
        folder, partition = f"{target}/{BUCKET}={bucket}", f"PARTITION ({BUCKET}={bucket})"
        if not path_exists(spark, folder):
            spark.createDataFrame([], TABLES[name].schema).write.parquet(folder)
        if bucket in stored:
            spark.sql(f"ALTER TABLE {full} {partition} SET LOCATION '{folder}'")
        else:
            added.append(f"{partition} LOCATION '{folder}'")
    if added:
        spark.sql(f"ALTER TABLE {full} ADD {' '.join(added)}")
    spark.catalog.refreshTable(full)


# Table properties: a word that is new after each removal of rows, and the
# number of loads that were committed when rows last lost the mark of theirs.
REMOVED, FOLDED = "scriptorium.removed", "scriptorium.folded"


def mark_removal(spark: SparkSession, name: str, db: str = "default") -> None:
    """Say that rows of a table go, before and after they do, so that what was
    counted over them is counted anew."""
    if TABLES[name].loaded:
        _mark(spark, f"{db}.{name}", REMOVED, uuid.uuid4().hex)


def change_marks(spark: SparkSession, name: str, db: str = "default") -> tuple[str, int]:
    """The word of the last removal and the number of folded loads."""
    shown = spark.sql(f"SHOW TBLPROPERTIES {db}.{name}").collect()
    found = {row["key"]: row["value"] for row in shown}
    return found.get(REMOVED, ""), int(found.get(FOLDED, 0))


def _mark(spark: SparkSession, full: str, key: str, value: object) -> None:
    spark.sql(f"ALTER TABLE {full} SET TBLPROPERTIES ('{key}' = '{value}')")


def touched_buckets(ids: DataFrame) -> list[int]:
    """The id ranges in which the one column of ``ids`` falls. The list is
    short: one entry per million ids at most."""
    ranges = ids.select(bucket_of(F.col(ids.columns[0])).alias("b")).distinct()
    return sorted(row["b"] for row in ranges.collect())


def change_rows(
    spark: SparkSession,
    name: str,
    changed_ids: DataFrame,
    change: Callable[[DataFrame], DataFrame],
    db: str = "default",
    as_of: dt.datetime | str | None = None,
) -> None:
    """Rewrite the id ranges of the changed ids. ``change`` maps the present
    rows of those ranges to the new ones."""
    buckets = touched_buckets(changed_ids)
    if buckets:
        rows = change(table_buckets(spark, name, buckets, db))
        replace_buckets(rows, buckets, name, db, as_of)


def upsert_rows(
    rows: DataFrame,
    name: str,
    db: str = "default",
    as_of: dt.datetime | str | None = None,
    order: Sequence[Column] = (),
) -> list[int]:
    """Store ``rows`` by the table's id; a stored row of the same id goes.
    Returns the id ranges that were rewritten.

    Stored keys are read only in the id ranges of the new ones, and there only
    in row groups that can hold one. A range in which none is stored gets the
    new rows appended; just the others are rewritten. Run again after a stop,
    it ends with the same rows. ``order`` as in ``upsert``; rows without an id
    are left out.
    """
    spark, key = rows.sparkSession, TABLES[name].id_col
    new = conform(rows.na.drop(subset=[key]), name, as_of)
    buckets = touched_buckets(new.select(key))
    if not buckets:
        return []
    stored = table_buckets(spark, name, buckets, db).select(key)
    met = stored.filter(within(F.col(key), key_intervals(new, key)))
    hit = touched_buckets(met.join(new.select(key), key, "left_semi"))
    in_hit = bucket_of(F.col(key)).isin(hit)
    if hit:
        changed = upsert(table_buckets(spark, name, hit, db), new.filter(in_hit), key, order)
        replace_buckets(changed, hit, name, db, as_of)
    if len(hit) < len(buckets):
        absent = new.filter(~in_hit)
        append(first_per_key(absent, [key], order) if order else absent, name, db, as_of)
    return hit


def update_rows(
    updates: DataFrame,
    name: str,
    key: str,
    column: str,
    db: str = "default",
    of: Column | None = None,
) -> list[int]:
    """Set ``column`` of the stored rows whose ``key``, not the id, is among
    the updates; returns the id ranges that were rewritten.

    The ranges are found on (key, id), in row groups that can hold an update
    and among the rows that ``of`` names; rows are read only there.
    """
    spark, id_col = updates.sparkSession, TABLES[name].id_col
    intervals = key_intervals(updates, key)
    if not intervals:
        return []
    stored = table(spark, name, db).filter(within(F.col(key), intervals))
    stored = stored if of is None else stored.filter(of)
    ids = stored.select(id_col, key).join(updates.select(key), key, "left_semi").select(id_col)
    buckets = touched_buckets(ids)
    if buckets:
        rows = update_from(table_buckets(spark, name, buckets, db), updates, key, column)
        replace_buckets(rows, buckets, name, db)
    return buckets


def truncate(spark: SparkSession, db: str = "default") -> None:
    """Empty every table. Ids start at 1 again, as no largest id is left."""
    for name, spec in TABLES.items():
        publish(spark.createDataFrame([], spec.schema), name, db)


def materialize(df: DataFrame, name: str, as_table: bool = False, db: str = "default") -> None:
    """A model as a view, or as a table rebuilt by each call. The table's
    files are written to a new folder before its location moves there."""
    if not as_table:
        df.createOrReplaceTempView(name)
        return
    spark, full = df.sparkSession, f"{db}.{name}"
    target = _fresh_path(spark.catalog.getDatabase(db).locationUri, name, "snapshot")
    df.write.parquet(target)
    if spark.catalog.tableExists(full) and spark.table(full).schema.simpleString() == df.schema.simpleString():
        spark.sql(f"ALTER TABLE {full} SET LOCATION '{target}'")
    else:
        spark.sql(f"DROP TABLE IF EXISTS {full}")
        spark.sql(f"CREATE TABLE {full} USING parquet LOCATION '{target}'")
    spark.catalog.refreshTable(full)


def _bucketed(df: DataFrame, name: str, cluster_by: str | None = None) -> DataFrame:
    """Add the id range and gather its rows; a range that holds a large share
    of all rows is split over several files. Each file has the table's order,
    so that a filter on that column skips row groups."""
    id_col = TABLES[name].id_col
    if id_col is None:
        return df
    gathered = df.withColumn(BUCKET, bucket_of(F.col(id_col))).hint("rebalance", BUCKET)
    cluster_by = cluster_by or TABLES[name].cluster_by
    return gathered if cluster_by is None else gathered.sortWithinPartitions(BUCKET, cluster_by)


def _stored_buckets(spark: SparkSession, full: str) -> list[int]:
    shown = spark.sql(f"SHOW PARTITIONS {full}").collect()  # one row per id range
    return [int(row["partition"].split("=")[1]) for row in shown]


def _fresh_path(root: str, name: str, label: str) -> str:
    return f"{root.rstrip('/')}/{name}/{label}-{uuid.uuid4().hex[:12]}"


def _root_of(spark: SparkSession, full: str) -> str:
    detail = spark.sql(f"DESCRIBE TABLE EXTENDED {full}").filter("col_name = 'Location'")
    return detail.first()["data_type"].rsplit("/", 2)[0]
