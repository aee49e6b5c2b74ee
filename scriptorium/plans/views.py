"""Staging views over the base tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def stg_papers(papers: DataFrame) -> DataFrame:
    return papers.select(
        F.col("id").alias("paper_id"),
        "arxiv_id",
        "title",
        "abstract",
        "published_at",
        "ingested_at",
    )


def stg_authors(authors: DataFrame) -> DataFrame:
    return authors.select(F.col("id").alias("author_id"), "name")


def stg_paper_authors(paper_authors: DataFrame) -> DataFrame:
    return paper_authors.select("paper_id", "author_id", "position")


def stg_categories(categories: DataFrame) -> DataFrame:
    return categories.select(F.col("id").alias("category_id"), "code", "name")


def stg_paper_categories(paper_categories: DataFrame) -> DataFrame:
    return paper_categories.select("paper_id", "category_id", "is_primary")


def staging_views(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {
        "stg_papers": stg_papers(tables["papers"]),
        "stg_authors": stg_authors(tables["authors"]),
        "stg_paper_authors": stg_paper_authors(tables["paper_authors"]),
        "stg_categories": stg_categories(tables["categories"]),
        "stg_paper_categories": stg_paper_categories(tables["paper_categories"]),
    }
