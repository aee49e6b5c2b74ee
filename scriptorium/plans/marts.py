"""Analytic marts over the staging views and raw tables.

Marts come unsorted; ``sorted_mart`` gives the order a reader expects.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from scriptorium.functions.jsonx import each_string
from scriptorium.functions.temporal import day_of, period_of, week_of
from scriptorium.operators.skew import member_pairs, rank_desc
from scriptorium.sinks.tables import touched_buckets
from scriptorium.sources.catalog import table, table_buckets


def author_counts(
    authors: DataFrame, links: DataFrame, min_papers: int | None = None
) -> DataFrame:
    """(name, n_papers); with ``min_papers`` only authors with more than that.

    Links are counted per author before names are looked up, so a prolific
    author is one row at the join.
    """
    per_id = links.groupBy("author_id").agg(F.count(F.lit(1)).alias("n"))
    counts = (
        per_id.join(authors.select("author_id", "name"), "author_id")
        .groupBy("name")
        .agg(F.sum("n").alias("n_papers"))
    )
    return counts if min_papers is None else counts.filter(F.col("n_papers") > min_papers)


def pair_counts(links: DataFrame, block: int = 2048, new: str | None = None) -> DataFrame:
    """(a, b, n) over author ids, a < b; with ``new``, a boolean column, of
    pairs with a new link."""
    pairs = member_pairs(links, "paper_id", "author_id", block, new)
    return pairs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"))


def coauthor_pairs(
    links: DataFrame, authors: DataFrame, top: int | None = None, block: int = 2048
) -> DataFrame:
    """(author_1, author_2, n_collabs), the smaller id first.

    Pairs are counted on ids and then named. ``top`` keeps the most frequent
    ones, equal counts in id order, so that only those need names; they come
    in that order.
    """
    counts = pair_counts(links, block)
    if top is not None:
        counts = counts.orderBy(F.desc("n"), "a", "b").limit(top)
    first = authors.select(F.col("author_id").alias("a"), F.col("name").alias("author_1"))
    second = authors.select(F.col("author_id").alias("b"), F.col("name").alias("author_2"))
    named = counts.join(first, "a").join(second, "b")
    if top is not None:
        named = named.orderBy(F.desc("n"), "a", "b")
    return named.select("author_1", "author_2", F.col("n").alias("n_collabs"))


def weekly_by_category(
    papers: DataFrame, links: DataFrame, categories: DataFrame, primary_only: bool = False
) -> DataFrame:
    """(week, category, n_papers).

    The paper join is the only large one; category codes are looked up for
    the counted (week, category_id) rows.
    """
    if primary_only:
        links = links.filter("is_primary")
    per_id = (
        links.select("paper_id", "category_id")
        .join(papers.select("paper_id", week_of(F.col("published_at")).alias("week")), "paper_id")
        .groupBy("week", "category_id")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return (
        per_id.join(categories.select("category_id", F.col("code").alias("category")), "category_id")
        .groupBy("week", "category")
        .agg(F.sum("n").alias("n_papers"))
    )


def weekly_between(
    spark: SparkSession, first: str, until: str, db: str = "default", primary_only: bool = False
) -> DataFrame:
    """``weekly_by_category`` of the stored papers published from ``first`` on
    and before ``until``.

    The dates are a filter on the scan of the papers, whose files are in that
    order; links are read only in the id ranges of the papers it finds.
    """
    at = F.col("published_at")
    papers = table(spark, "papers", db).filter(
        (at >= F.lit(first).cast("timestamp")) & (at < F.lit(until).cast("timestamp"))
    ).select(F.col("id").alias("paper_id"), "published_at")
    ranges = touched_buckets(papers.select("paper_id"))
    links = table_buckets(spark, "paper_categories", ranges, db) if ranges else table(
        spark, "paper_categories", db).limit(0)
    codes = table(spark, "categories", db).select(F.col("id").alias("category_id"), "code")
    return weekly_by_category(papers, links, codes, primary_only)


def ingestion_health(
    papers: DataFrame, embeddings: DataFrame, enrichments: DataFrame
) -> DataFrame:
    """(day, papers_ingested, papers_embedded, papers_enriched), 0 for none.

    Each side is counted per day before the outer joins.
    """

    def daily(df: DataFrame, ts: str, count: str) -> DataFrame:
        return df.groupBy(day_of(F.col(ts)).alias("day")).agg(F.count(F.lit(1)).alias(count))

    p = daily(papers, "ingested_at", "papers_ingested").alias("p")
    e = daily(embeddings, "created_at", "papers_embedded").alias("e")
    n = daily(enrichments, "enriched_at", "papers_enriched").alias("n")
    either = F.coalesce(F.col("p.day"), F.col("e.day"))
    joined = p.join(e, F.col("p.day") == F.col("e.day"), "full_outer").join(
        n, either == F.col("n.day"), "full_outer"
    )
    counts = ("papers_ingested", "papers_embedded", "papers_enriched")
    return joined.select(
        F.coalesce(F.col("p.day"), F.col("e.day"), F.col("n.day")).alias("day"),
        *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in counts],
    )


def json_topics(enrichments: DataFrame, column: str = "custom_topics") -> DataFrame:
    """(paper_id, topic), one row per array element."""
    return enrichments.select("paper_id", each_string(F.col(column)).alias("topic"))


def trending_topics(papers: DataFrame, enrichments: DataFrame, unit: str = "day") -> DataFrame:
    """(period, topic, n_papers, topic_rank): topics ranked within each period."""
    dated = json_topics(enrichments).join(
        papers.select("paper_id", period_of(F.col("published_at"), unit).alias("period")),
        "paper_id",
    )
    counts = dated.groupBy("period", "topic").agg(F.count(F.lit(1)).alias("n_papers"))
    return rank_desc(counts, ["period"], "n_papers", "topic_rank").select(
        "period", "topic", "n_papers", "topic_rank"
    )


# The reading order of each mart.
MART_ORDER = {
    "author_counts": ["-n_papers", "name"],
    "coauthor_pairs": ["-n_collabs", "author_1", "author_2"],
    "weekly_by_category": ["week", "category"],
    "ingestion_health": ["day"],
}


def sorted_mart(df: DataFrame, mart: str) -> DataFrame:
    """Nulls last going up and first going down."""
    keys = [
        F.col(c[1:]).desc_nulls_first() if c.startswith("-") else F.col(c).asc_nulls_last()
        for c in MART_ORDER[mart]
    ]
    return df.orderBy(*keys)
