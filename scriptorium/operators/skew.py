"""Operators whose plain form would put a whole hot group into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

def member_pairs(
    df: DataFrame, key: str, member: str, block: int = 2048, new: str | None = None
) -> DataFrame:
    """``(key, a, b)`` for every two members ``a < b`` that share a key. With
    ``new``, a boolean column, only those of which one row at least is new.

    The members of each key are cut into blocks of about ``block`` by hash,
    most keys into one. Blocks ``i <= j`` of a key meet in a group of their
    own, each pair of blocks once, so no group has more than about two blocks
    of members, however many a key has.
    """
    is_new = F.lit(True) if new is None else F.coalesce(F.col(new), F.lit(False))
    rows = df.select(key, member, is_new.alias("new")).na.drop(subset=[key, member])
    sizes = rows.groupBy(key).agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
    dealt = rows.join(sizes, key).withColumn(
        "own", F.pmod(F.xxhash64(member), F.col("blocks")).cast("int"))
    later = F.explode(F.sequence(F.col("own"), F.col("blocks") - 1))
    earlier = F.explode(F.sequence(F.lit(0), F.col("own")))
    left = dealt.select(key, F.col(member).alias("x"), F.col("new").alias("p"), F.col("own").alias("i"), later.alias("j"))
    right = dealt.select(key, F.col(member).alias("y"), F.col("new").alias("q"), F.col("own").alias("j"), earlier.alias("i"))
    met = left.join(right, [key, "i", "j"])
    # Within a block each two members meet in both orders, between blocks once.
    once = met.filter((F.col("x") < F.col("y")) | ((F.col("i") < F.col("j")) & (F.col("x") != F.col("y"))))
    once = once if new is None else once.filter("p or q")
    return once.select(key, F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))


def rank_desc(df: DataFrame, by: Sequence[str], measure: str, name: str = "rank") -> DataFrame:
    """SQL ``rank()`` per ``by`` over an integer measure, largest first.

    The window runs over the distinct values of the measure, not over the
    rows: a group whose counts sum to N has fewer than sqrt(2 N) of those.
    Each row then looks up the rank of its value.
    """
    by = list(by)
    levels = df.groupBy(*by, measure).agg(F.count(F.lit(1)).alias("tied"))
    above = (
        Window.partitionBy(*by)
        .orderBy(F.desc(measure))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    ranks = levels.select(
        *by, measure, (F.coalesce(F.sum("tied").over(above), F.lit(0)) + 1).alias(name)
    )
    return df.join(ranks, [*by, measure])


def top_per_group(
    df: DataFrame, by: Sequence[str], order: Sequence[Column], k: int, salts: int = 64
) -> DataFrame:
    """The first ``k`` rows of each group in the given order.

    The first rows of parts of each group, dealt by the task that has them,
    come first, so that no task gets a whole group, then those of the groups. For a small ``k`` the
    optimizer cuts every map task to ``k`` rows per part before the shuffle.
    """
    salt = F.pmod(F.spark_partition_id(), F.lit(salts))
    parts = _first_rows(df.withColumn("salt", salt), [*by, "salt"], order, k).drop("salt")
    return _first_rows(parts, by, order, k)


def _first_rows(df: DataFrame, by: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    window = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn("rn", F.row_number().over(window)).filter(F.col("rn") <= k).drop("rn")


def first_per_key(df: DataFrame, key: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the first in the given order. The optimizer cuts every
    map task to one row per key."""
    return _first_rows(df, key, order, 1)
