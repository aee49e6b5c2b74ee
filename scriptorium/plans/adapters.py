"""The corpus tables as views over an order warehouse.

An order is a paper, a supplier an author, a part type a category, a line the
link between them; events stand for enrichments, documents for raw text. The
views are whole: no row of a source table is left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from scriptorium.functions.text import object_path
from scriptorium.operators.ids import assign_ids
from scriptorium.session import tune


class Warehouse:
    """The given Parquet tables of one folder, read lazily by name."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = tune(spark)
        self.folder = folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def _arxiv_id(order_key: Column) -> Column:
    return F.concat(F.lit("o"), order_key.cast("string"))


def papers(w: Warehouse) -> DataFrame:
    arxiv_id = _arxiv_id(F.col("o_orderkey"))
    stored = F.when(F.col("o_orderstatus") == "F", object_path(arxiv_id))
    return w.orders.select(
        F.col("o_orderkey").alias("id"),
        arxiv_id.alias("arxiv_id"),
        F.concat_ws(" #", "o_orderpriority", F.col("o_orderkey").cast("string")).alias("title"),
        F.concat(F.lit("order of customer "), F.col("o_custkey").cast("string")).alias("abstract"),
        F.col("o_orderdate").alias("published_at"),
        F.col("o_orderdate").alias("updated_at"),
        F.concat(F.lit("pdf/"), arxiv_id).alias("pdf_url"),
        stored.alias("pdf_object_path"),
        F.col("o_orderdate").alias("ingested_at"),
        F.col("o_orderstatus").alias("status"),
    )


def authors(w: Warehouse) -> DataFrame:
    return w.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))


def paper_authors(w: Warehouse) -> DataFrame:
    return w.lineitem.groupBy(
        F.col("l_orderkey").alias("paper_id"), F.col("l_suppkey").alias("author_id")
    ).agg(F.min("l_linenumber").alias("position"))


def category_codes(w: Warehouse) -> DataFrame:
    return w.part.select(F.col("p_type").alias("code")).distinct()


def categories(w: Warehouse) -> DataFrame:
    """With dense ids in code order, made by the library's own key operator."""
    return assign_ids(category_codes(w), "code").select(
        "id", "code", F.lower("code").alias("name")
    )


def coded_categories(w: Warehouse) -> DataFrame:
    """The staging view with the code as its own key, for marts."""
    return category_codes(w).select(F.col("code").alias("category_id"), "code")


def paper_codes(w: Warehouse) -> DataFrame:
    """(paper_id, category_id, is_primary) keyed by code. The category of a
    paper's first line is its primary one."""
    lines = w.lineitem.select("l_orderkey", "l_partkey", "l_linenumber")
    typed = lines.join(
        w.part.select(F.col("p_partkey").alias("l_partkey"), "p_type"), "l_partkey"
    )
    # (line number, part) packed into one long: the first line of each code.
    place = F.col("l_linenumber").cast("bigint") * F.lit(1 << 40) + F.col("l_partkey")
    firsts = typed.groupBy(
        F.col("l_orderkey").alias("paper_id"), F.col("p_type").alias("category_id")
    ).agg(F.min(place).alias("place"))
    # At most one row per code is left in each paper.
    order = Window.partitionBy("paper_id").orderBy("place", "category_id")
    return firsts.select(
        "paper_id", "category_id", (F.row_number().over(order) == 1).alias("is_primary")
    )


def staging(w: Warehouse) -> DataFrame:
    """Papers with their name and code arrays, in line order, repeats kept."""
    lines = (
        w.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey")
        .join(w.supplier.select(F.col("s_suppkey").alias("l_suppkey"), "s_name"), "l_suppkey")
        .join(w.part.select(F.col("p_partkey").alias("l_partkey"), "p_type"), "l_partkey")
    )
    arrays = lines.groupBy(F.col("l_orderkey").alias("id")).agg(
        F.array_sort(F.collect_list(F.struct("l_linenumber", "l_suppkey", "s_name"))).alias("a"),
        F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "p_type"))).alias("c"),
    )
    listed = arrays.select(
        "id",
        F.col("a.s_name").alias("authors"),
        F.col("c.p_type").alias("all_categories"),
        F.element_at(F.col("c.p_type"), 1).alias("primary_category"),
    )
    return papers(w).join(listed, "id")


def enrichments(w: Warehouse) -> DataFrame:
    """One enrichment per event; small values stand for missing, empty and
    broken results."""
    value = F.col("value")
    topics = F.to_json(
        F.array("event_type", F.concat(F.lit("k"), F.get_json_object("props", "$.k")))
    )
    return w.events.select(
        F.col("event_id").alias("id"),
        F.col("event_id").alias("paper_id"),
        F.when(value >= 10, F.col("event_type")).alias("summary"),
        F.when(value >= 5, topics).when(value >= 2.5, F.lit("not json")).alias("methods"),
        F.when(F.col("event_type") != "error", topics).alias("datasets"),
        F.when(value >= 6, topics)
        .when(value >= 4, F.lit("[]"))
        .when(value >= 2, F.lit("not json"))
        .alias("custom_topics"),
        F.col("ts").alias("enriched_at"),
    )


def event_papers(w: Warehouse) -> DataFrame:
    return w.events.select(F.col("event_id").alias("paper_id"), F.col("ts").alias("published_at"))


def embeddings(w: Warehouse) -> DataFrame:
    return w.embeddings.select(
        F.col("vec_id").alias("paper_id"),
        "embedding",
        F.concat(F.lit("model-"), F.col("label").cast("string")).alias("model_used"),
    )


def raw_documents(w: Warehouse) -> DataFrame:
    """Documents as raw bronze records: copies of a text share an id, and
    Spanish ones have no title."""
    stamp = F.lit("2024-01-01T00:00:00Z")
    return w.documents.select(
        F.md5(F.col("text").cast("binary")).alias("arxiv_id"),
        F.when(F.col("lang") != "es", F.concat("lang", F.lit(" \t\n "), "source", F.lit(" "))).alias(
            "title"
        ),
        F.array("source", "lang").alias("authors"),
        F.col("text").alias("abstract"),
        F.col("lang").alias("primary_category"),
        F.array("lang", "source").alias("all_categories"),
        F.concat(F.lit("pdf/"), F.col("doc_id").cast("string")).alias("pdf_url"),
        stamp.alias("published_at"),
        stamp.alias("updated_at"),
        "doc_id",
    )


def dated_documents(w: Warehouse) -> DataFrame:
    """Documents as raw bronze records of two run dates, all made from the
    digest of the text: copies are equal, some titles meet, some records lack
    a title or a date."""
    digest = F.md5(F.col("text").cast("binary"))

    def hex_digit(place: int) -> Column:
        return F.substring("arxiv_id", place, 1)

    def named(prefix: str, place: int) -> Column:
        return F.concat(F.lit(prefix), hex_digit(place))

    stamp = F.when(hex_digit(7) != "0", F.lit("2024-01-01T00:00:00Z"))
    return w.documents.filter("text is not null").select(digest.alias("arxiv_id"), "text").select(
        "arxiv_id",
        F.when(hex_digit(32) != "f", F.substring("arxiv_id", 1, 3)).alias("title"),
        F.array(named("a", 1), named("b", 2)).alias("authors"),
        F.col("text").alias("abstract"),
        named("c", 4).alias("primary_category"),
        F.array(named("c", 4), named("c", 6)).alias("all_categories"),
        F.concat(F.lit("pdf/"), "arxiv_id").alias("pdf_url"),
        stamp.alias("published_at"),
        stamp.alias("updated_at"),
        F.when(hex_digit(5) < "8", "2024-01-01").otherwise("2024-01-02").alias("ds"),
    )
