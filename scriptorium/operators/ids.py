"""Dense surrogate keys without an identity column or a global window."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from scriptorium.session import cut_lineage


def assign_ids(
    df: DataFrame, natural_key: str, start: int = 0, partitions: int | None = None
) -> DataFrame:
    """Add ``id`` = ``start`` + 1, 2, 3, ... in the order of a unique key.

    Only the key column is range-partitioned, sorted and checkpointed; the
    checkpoint pins each key to its partition and position. A partition's
    offset is the number of keys before it: one small row per partition, the
    only thing that is summed in one place. The rest of each row joins back on
    the key and is shuffled at most once.
    """
    spark = df.sparkSession
    partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = cut_lineage(
        df.select(natural_key)
        .repartitionByRange(partitions, natural_key)
        .sortWithinPartitions(natural_key)
    )
    # High bits: partition number; low 33 bits: position in the partition.
    place = keys.withColumn("place", F.monotonically_increasing_id()).select(
        natural_key,
        F.shiftright("place", 33).alias("part"),
        F.col("place").bitwiseAND(F.lit((1 << 33) - 1)).alias("position"),
    )
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        place.groupBy("part")
        .agg(F.count(F.lit(1)).alias("n_keys"))
        .select("part", F.coalesce(F.sum("n_keys").over(before), F.lit(0)).alias("offset"))
    )
    ids = place.join(F.broadcast(offsets), "part").select(
        natural_key, (F.lit(start) + F.col("offset") + F.col("position") + 1).alias("id")
    )
    if df.columns == [natural_key]:
        return ids
    return df.join(ids, natural_key)


def last_id(table: DataFrame, id_col: str = "id") -> int:
    """The largest id in use; 0 for an empty table."""
    return table.agg(F.max(id_col)).first()[0] or 0
