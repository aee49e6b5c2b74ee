"""Reading, writing scratch tables, words, and connected components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from scriptorium.session import scratch_path

SIMILAR = 0.8
WIDTH = 5


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared folder and read again."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def words_of(text: Column) -> Column:
    """Lower-case runs of letters and digits; a null text has none."""
    parts = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+")
    return F.filter(parts, lambda w: w != "")


def components(links: DataFrame) -> DataFrame:
    """``(id, root)`` for every id in ``links (a, b)``: the smallest id reachable.

    Each round gives an id the smallest label among its neighbours, then jumps
    to that label's own label, so a chain halves per round. Rounds end when no
    label changes. Labels are written each round and never leave Spark.
    """
    links = links.select("a", "b").filter("a <> b").distinct()
    both = stored(
        links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))), "links"
    )
    labels = stored(
        both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("m"))
        .select("id", F.least("id", "m").alias("root")), "labels",
    )
    while True:
        near = (
            both.join(labels.withColumnRenamed("id", "b"), "b")
            .groupBy(F.col("a").alias("id")).agg(F.min("root").alias("near"))
        )
        step = labels.join(near, "id").select(
            "id", "root", F.least("root", "near").alias("next")
        )
        up = labels.select(F.col("id").alias("next"), F.col("root").alias("above"))
        moved = stored(
            step.join(up, "next", "left").select(
                "id", F.least("next", F.coalesce("above", "next")).alias("new"), "root"
            ), "labels",
        )
        changed = moved.filter("new <> root").limit(1).count()
        labels = moved.select("id", F.col("new").alias("root"))
        if not changed:
            return labels
