"""The embedding job: which papers, which text, and the upsert."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from scriptorium.functions.temporal import clock
from scriptorium.functions.text import embedding_text
from scriptorium.operators.embed import ClientEmbedder, HashingEmbedder, embed, pending
from scriptorium.schemas import EMBEDDING_MODEL
from scriptorium.session import scratch_path
from scriptorium.sinks.tables import upsert_rows
from scriptorium.sources.catalog import all_tables

# Author positions that form one piece of a list before pieces are joined.
_PIECE = 4096


def author_list(links: DataFrame, authors: DataFrame) -> DataFrame:
    """(paper_id, authors): names joined by ``', '`` in author order.

    Long lists are put together from pieces of consecutive positions, so the
    sorting inside a very large paper is shared between tasks.
    """
    named = links.join(authors.select(F.col("id").alias("author_id"), "name"), "author_id")
    pieces = named.groupBy("paper_id", F.floor(F.col("position") / _PIECE).alias("piece")).agg(
        F.expr("listagg(name, ', ') WITHIN GROUP (ORDER BY position, author_id)").alias("names")
    )
    return pieces.groupBy("paper_id").agg(
        F.expr("listagg(names, ', ') WITHIN GROUP (ORDER BY piece)").alias("authors")
    )


def embedding_inputs(papers: DataFrame, links: DataFrame, authors: DataFrame) -> DataFrame:
    """(paper_id, text) of papers whose object has landed. Papers without
    authors drop out."""
    ready = papers.filter(F.col("pdf_object_path").isNotNull()).select(
        F.col("id").alias("paper_id"), "title", "abstract"
    )
    listed = author_list(links.join(ready.select("paper_id"), "paper_id", "left_semi"), authors)
    return ready.join(listed, "paper_id").select(
        "paper_id",
        embedding_text(F.col("title"), F.col("authors"), F.col("abstract")).alias("text"),
    )


def pending_papers(
    papers: DataFrame, embeddings: DataFrame, model: str | None = None, recompute: bool = False
) -> DataFrame:
    """Papers whose object has landed and that have no vector yet. Decided on
    ids, before any author list is put together."""
    ready = papers.filter(F.col("pdf_object_path").isNotNull())
    keyed = ready.withColumn("paper_id", F.col("id"))
    return pending(keyed, embeddings, model, recompute).drop("paper_id")


def run_embedding_job(
    spark: SparkSession,
    db: str = "default",
    embedder: HashingEmbedder | ClientEmbedder | None = None,
    model: str = EMBEDDING_MODEL,
    recompute: bool = False,
    as_of: dt.datetime | str | None = None,
    partitions: int | None = None,
) -> bool:
    """Embed what is due and upsert it; False when nothing was due.

    Vectors are written once to the shared folder, so a lost executor or a
    second read never calls the model again. Only the id ranges in which some
    vector is replaced are rewritten; to others the new ones are appended.
    """
    t = all_tables(spark, db)
    due = pending_papers(t["papers"], t["paper_embeddings"], model, recompute)
    if due.isEmpty():
        return False
    inputs = embedding_inputs(due, t["paper_authors"], t["authors"])
    path = scratch_path(spark, "vectors")
    partitions = partitions or 4 * spark.sparkContext.defaultParallelism
    embed(inputs, embedder, model, partitions).write.parquet(path)
    fresh = spark.read.parquet(path).withColumn("created_at", clock(as_of))
    if fresh.isEmpty():
        return False
    upsert_rows(fresh, "paper_embeddings", db, as_of)
    return True
