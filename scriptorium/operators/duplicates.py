"""Groups of copies: documents and vectors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from scriptorium.session import cut_lineage


def digest_of(columns: Sequence[str]) -> Column:
    """One 32-byte digest of several texts; null differs from every text."""
    each = [
        F.coalesce(F.sha2(F.col(c).cast("binary"), 256), F.lit("null")) for c in columns
    ]
    return F.unhex(F.sha2(F.concat_ws(",", *each).cast("binary"), 256))


def duplicate_members(
    df: DataFrame, by: Sequence[str], id_col: str, other: str
) -> DataFrame:
    """The rows that are equal to another one in ``by``: ``(first_id, n,
    ordinal, id, other)``, one row per member of a group of any size, counted
    from 1 in the order of the ids. ``first_id`` names the group.

    Rows are grouped by a digest of the texts, so texts stay out of the
    shuffle. Members are range-partitioned by group and id and pinned by a
    checkpoint; a member's ordinal is its place in its partition, less that of
    the group's first member there, plus the members in partitions before: a
    group may run over many partitions.
    """
    slim = df.select(
        F.col(id_col).alias("id"), F.col(other).alias("other"), digest_of(by).alias("digest"))
    groups = (
        slim.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first_id"))
        .filter(F.col("n") > 1))
    members = cut_lineage(
        slim.join(groups, "digest").select("first_id", "n", "id", "other")
        .repartitionByRange("first_id", "id").sortWithinPartitions("first_id", "id"))
    place = F.monotonically_increasing_id()  # high bits: the partition
    placed = members.withColumn("place", place).withColumn("part", F.shiftright("place", 33))
    spans = placed.groupBy("first_id", "part").agg(
        F.min("place").alias("opens"), F.count(F.lit(1)).alias("here"))
    before = Window.partitionBy("first_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.select(
        "first_id", "part",
        (F.coalesce(F.sum("here").over(before), F.lit(0)) + 1 - F.col("opens")).alias("shift"))
    return placed.join(spans, ["first_id", "part"]).select(
        "first_id", "n", (F.col("place") + F.col("shift")).alias("ordinal"), "id", "other")


def duplicate_docs(
    df: DataFrame, by: Sequence[str], id_col: str, other: str, part_rows: int = 100_000
) -> DataFrame:
    """Groups of rows equal in ``by``: ``(*by, part, n, ids, others)``, the
    two arrays in id order.

    Members are listed by their ordinals: part 0 has the first ``part_rows``,
    part 1 the next, so no array grows with its group.
    """
    part = F.floor((F.col("ordinal") - 1) / part_rows)
    member = F.struct("ordinal", "id", "other")
    parts = (
        duplicate_members(df, by, id_col, other)
        .groupBy("first_id", "n", part.alias("part"))
        .agg(F.array_sort(F.collect_list(member)).alias("members"))
        .select(
            "first_id",
            "part",
            "n",
            F.col("members.id").alias("ids"),
            F.col("members.other").alias("others"),
        )
    )
    texts = df.select(F.col(id_col).alias("first_id"), *by)
    return parts.join(texts, "first_id").select(*by, "part", "n", "ids", "others")


def duplicate_vectors(embeddings: DataFrame, papers: DataFrame) -> DataFrame:
    """(paper_id, title, n, embedding) for every vector that occurs more than
    once. -0.0 equals 0.0 here and null equals nothing, as in SQL.

    A 64-bit hash first finds the candidates, so that whole vectors are moved
    and compared only for those.
    """
    hashed = embeddings.filter(F.col("embedding").isNotNull()).select(
        "paper_id", "embedding", F.xxhash64("embedding").alias("h")
    )
    repeated = hashed.groupBy("h").agg(F.count(F.lit(1)).alias("seen")).filter(F.col("seen") > 1)
    candidates = hashed.join(repeated.select("h"), "h", "left_semi")
    copies = (
        candidates.groupBy("h", "embedding")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") > 1)
    )
    paired = candidates.alias("c").join(
        copies.alias("v"),
        (F.col("c.h") == F.col("v.h")) & (F.col("c.embedding") == F.col("v.embedding")),
    )
    titled = paired.select("c.paper_id", "v.n", "c.embedding").join(
        papers.select(F.col("id").alias("paper_id"), "title"), "paper_id"
    )
    return titled.select("paper_id", "title", "n", "embedding").distinct()
