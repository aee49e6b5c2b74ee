"""Array columns to link rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def unnest(df: DataFrame, array_col: str, value: str) -> DataFrame:
    """One row per element; null and empty arrays give none."""
    kept = [c for c in df.columns if c != array_col]
    return df.select(*kept, F.explode(array_col).alias(value))


def unnest_ordinal(df: DataFrame, array_col: str, value: str, ordinal: str) -> DataFrame:
    """One row per element with its place in the array, counted from 1."""
    kept = [c for c in df.columns if c != array_col]
    exploded = df.select(*kept, F.posexplode(array_col).alias("zero_based", value))
    return exploded.select(*kept, value, (F.col("zero_based") + 1).alias(ordinal))


def membership_join(df: DataFrame, array_col: str, dim: DataFrame, key: str) -> DataFrame:
    """``dim.key = ANY(array_col)`` as an equi-join over distinct elements."""
    elements = df.withColumn(array_col, F.array_distinct(array_col))
    return unnest(elements, array_col, key).join(dim, key)


def author_links(staging: DataFrame, papers: DataFrame, authors: DataFrame) -> DataFrame:
    """(paper_id, author_id, position). Papers are resolved while a row is
    still one paper; a name listed twice keeps its first place."""
    resolved = staging.select("arxiv_id", "authors").join(
        papers.select("arxiv_id", F.col("id").alias("paper_id")), "arxiv_id"
    )
    named = unnest_ordinal(resolved.select("paper_id", "authors"), "authors", "name", "position")
    return (
        named.join(authors.select("name", F.col("id").alias("author_id")), "name")
        .groupBy("paper_id", "author_id")
        .agg(F.min("position").alias("position"))
    )


def category_links(staging: DataFrame, papers: DataFrame, categories: DataFrame) -> DataFrame:
    """(paper_id, category_id, is_primary), one row per paper and category."""
    resolved = staging.select("arxiv_id", "primary_category", "all_categories").join(
        papers.select("arxiv_id", F.col("id").alias("paper_id")), "arxiv_id"
    )
    matched = membership_join(
        resolved.drop("arxiv_id"),
        "all_categories",
        categories.select("code", F.col("id").alias("category_id")),
        "code",
    )
    is_primary = F.coalesce(F.col("code") == F.col("primary_category"), F.lit(False))
    return (
        matched.select("paper_id", "category_id", is_primary.alias("is_primary"))
        .groupBy("paper_id", "category_id")
        .agg(F.max("is_primary").alias("is_primary"))
    )
