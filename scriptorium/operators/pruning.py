"""Bounds of a set of keys, so that a scan skips what cannot hold them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def key_intervals(keys: DataFrame, key: str, most: int = 32) -> list[tuple]:
    """At most ``most`` intervals (least, greatest) that hold every key and do
    not overlap. Nulls are in none."""
    dealt = keys.select(key).na.drop().repartitionByRange(most, key)
    bounds = dealt.groupBy(F.spark_partition_id()).agg(F.min(key), F.max(key))
    return sorted((row[1], row[2]) for row in bounds.collect())  # ``most`` rows


def within(column: Column, intervals: list[tuple]) -> Column:
    """Whether a value is in one of the intervals: a filter that reaches the
    scan, where the least and greatest value of a row group are compared."""
    return reduce(
        Column.__or__, [column.between(F.lit(low), F.lit(high)) for low, high in intervals],
        F.lit(False))
