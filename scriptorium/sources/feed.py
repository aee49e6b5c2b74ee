"""Landed Atom feed files to bronze rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from scriptorium.functions.text import path_tail, strip
from scriptorium.schemas import BRONZE, FEED_ENTRY


def read_feed(spark: SparkSession, path: str) -> DataFrame:
    """One bronze row per ``entry`` element of the feed files under ``path``."""
    entries = spark.read.format("xml").option("rowTag", "entry").schema(FEED_ENTRY).load(path)
    return entries_to_bronze(entries)


def entries_to_bronze(entries: DataFrame) -> DataFrame:
    """Typed feed entries to bronze columns. Of several links titled ``pdf``
    the last one counts; none gives a null ``pdf_url``."""
    pdf_links = F.filter("link", lambda link: link["_title"] == "pdf")
    names = F.transform("author", lambda author: author["name"])
    terms = F.transform("category", lambda category: category["_term"])
    none = F.array().cast("array<string>")
    return entries.select(
        path_tail(F.col("id")).alias("arxiv_id"),
        strip(F.col("title")).alias("title"),
        F.coalesce(names, none).alias("authors"),
        strip(F.col("summary")).alias("abstract"),
        F.col("`arxiv:primary_category`._term").alias("primary_category"),
        F.coalesce(terms, none).alias("all_categories"),
        F.try_element_at(pdf_links, F.lit(-1))["_href"].alias("pdf_url"),
        F.col("published").alias("published_at"),
        F.col("updated").alias("updated_at"),
    ).select(*BRONZE.fieldNames())
