"""Insert, upsert, update and delete as DataFrames.

Each returns rows to append or a full new snapshot; nothing is written here.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from scriptorium.operators.skew import first_per_key
from scriptorium.schemas import TABLES, referrers


def insert_absent(
    existing: DataFrame, new: DataFrame, key: Sequence[str], order: Sequence[Column] = ()
) -> DataFrame:
    """Rows of ``new`` whose key is not in ``existing``, one per key.

    Without an order the rows of one key must be equal, as for a column of
    names. Rows with a null in the key are kept apart by no unique rule and
    could never be linked, so they are left out.
    """
    key = list(key)
    new = new.na.drop(how="any", subset=key)
    unique = first_per_key(new, key, order) if order else new.dropDuplicates(key)
    return unique.join(met_keys(existing, new, key), key, "left_anti")


def met_keys(existing: DataFrame, new: DataFrame, key: Sequence[str]) -> DataFrame:
    """The stored keys that new rows have too. The stored side is only probed,
    so it is not shuffled where Spark knows the new keys to be few, as those of
    a written batch; and what is left of it is no larger than the batch."""
    return existing.select(*key).join(new.select(*key), list(key), "left_semi")


def insert_absent_links(
    existing: DataFrame, new: DataFrame, key: Sequence[str], least: str
) -> DataFrame:
    """The same for a composite key; a repeated link keeps its least value."""
    key = list(key)
    unique = new.na.drop(how="any", subset=key).groupBy(*key).agg(F.min(least).alias(least))
    return unique.join(met_keys(existing, new, key), key, "left_anti").select(*new.columns)


class ConflictError(ValueError):
    """New rows clash with a unique column."""


def split_conflicts(
    existing: DataFrame,
    new: DataFrame,
    unique_col: str,
    key: str,
    order: Sequence[Column],
    mode: str = "quarantine",
) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) under a second unique column.

    An existing row always wins; among newcomers the first in the given order
    does. ``strict`` raises instead when anything would be rejected.
    """
    if mode not in ("strict", "quarantine"):
        raise ValueError(f"unknown mode {mode!r}")
    accepted = first_per_key(new, [unique_col], order).join(
        met_keys(existing, new, [unique_col]), unique_col, "left_anti"
    )
    rejected = new.join(accepted.select(key), key, "left_anti")
    if mode == "strict":
        shown = [row[0] for row in rejected.select(unique_col).distinct().limit(20).collect()]
        if shown:
            raise ConflictError(f"{unique_col} is not unique, for example: {shown}")
    return accepted.select(*new.columns), rejected.select(*new.columns)


def upsert(
    existing: DataFrame, new: DataFrame, key: str, order: Sequence[Column] = ()
) -> DataFrame:
    """A full snapshot in which ``new`` replaces rows of the same key. With an
    order the first new row of a key is taken; else keys must be unique."""
    new = first_per_key(new, [key], order) if order else new
    kept = existing.join(new.select(key), key, "left_anti")
    return kept.unionByName(new.select(*existing.columns)).select(*existing.columns)


def update_from(existing: DataFrame, updates: DataFrame, key: str, column: str) -> DataFrame:
    """A full snapshot with ``column`` taken from ``updates`` where it has one."""
    fresh = updates.select(key, F.col(column).alias("fresh_value"))
    joined = existing.join(fresh, key, "left")
    return joined.withColumn(column, F.coalesce("fresh_value", column)).select(*existing.columns)


def keep_latest(df: DataFrame, by: str, id_col: str = "id") -> DataFrame:
    """Per value of ``by`` the row with the largest id; nulls are never equal,
    so rows without a value all stay.

    Only (value, id) goes through the grouping, combined map-side; the rows
    themselves move by id, which is unique, and not by the repeated value.
    """
    latest = df.filter(F.col(by).isNotNull()).groupBy(by).agg(F.max(id_col).alias(id_col))
    named = df.filter(F.col(by).isNotNull()).join(latest.select(id_col), id_col, "left_semi")
    return named.unionByName(df.filter(F.col(by).isNull()))


def cascade(child: DataFrame, deleted: DataFrame, fk: str, key: str = "id") -> DataFrame:
    """The child rows that survive the deletion of the given parents."""
    return child.join(deleted.select(F.col(key).alias(fk)), fk, "left_anti").select(*child.columns)


def deleted_rows(
    tables: Mapping[str, DataFrame], root: str, gone: DataFrame, key: str = "id"
) -> dict[str, DataFrame]:
    """Per table the rows that go with the ``root`` rows whose ``key`` is in
    ``gone``: those rows, and level by level what refers to a deleted row.

    The declared parents say which tables these are; of them only those in
    ``tables`` are walked. A row that refers to several deleted rows may come
    back once for each. A null reference refers to nothing.
    """
    dead = {root: tables[root].join(gone.select(key), key, "left_semi").select(*tables[root].columns)}
    for name in referrers(root)[1:]:
        if name in tables:
            dead[name] = referring(tables[name], name, dead)
    return dead


def referring(rows: DataFrame, name: str, dead: Mapping[str, DataFrame]) -> DataFrame:
    """The rows of table ``name`` that refer to a row of ``dead``, once for
    each parent table in which they do."""
    hits = [
        rows.join(dead[parent].select(F.col(key).alias(fk)), fk, "left_semi").select(*rows.columns)
        for fk, (parent, key) in TABLES[name].parents.items() if parent in dead
    ]
    return reduce(DataFrame.unionByName, hits) if hits else rows.filter(F.lit(False))


def surviving_rows(
    tables: Mapping[str, DataFrame], root: str, gone: DataFrame, key: str = "id"
) -> dict[str, DataFrame]:
    """Per table that the deletion reaches, the rows that stay. A row is
    compared with deleted keys only, so no table is read for another's sake
    unless that one is referred to itself."""
    dead = deleted_rows(tables, root, gone, key)
    out = {root: tables[root].join(gone.select(key), key, "left_anti").select(*tables[root].columns)}
    for name in dead:
        if name != root:
            out[name] = without_parents(tables[name], name, dead)
    return out


def without_parents(rows: DataFrame, name: str, dead: Mapping[str, DataFrame]) -> DataFrame:
    """The rows of table ``name`` that refer to no row of ``dead``."""
    for fk, (parent, key) in TABLES[name].parents.items():
        if parent in dead:
            rows = cascade(rows, dead[parent], fk, key)
    return rows
