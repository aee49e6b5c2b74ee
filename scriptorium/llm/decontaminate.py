"""Benchmark decontamination by size-partitioned MinHash containment (native)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from scriptorium.llm.common import SIMILAR, WIDTH, stored, words_of

BROADCAST_ROWS = 1_000_000


def shingles_at(words: str, width: Column) -> Column:
    """The word runs of ``width`` words, in order."""
    last = F.size(words) - width
    return F.when(last >= 0, F.transform(
        F.sequence(F.lit(0), last), lambda i: F.concat_ws(" ", F.slice(words, i + 1, width))
    )).otherwise(F.array().cast("array<string>"))


def hashes_at(words: str, width: int) -> Column:
    last = F.size(words) - width
    return F.when(last >= 0, F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(
        *[F.get(F.col(words), i + k) for k in range(width)]
    ))).otherwise(F.array().cast("array<bigint>"))


def item_hash(shingle: Column, width: int) -> Column:
    parts = F.split(shingle, " ")
    return F.xxhash64(*[F.get(parts, F.lit(k)) for k in range(width)])


def contained(
    docs: DataFrame, items: DataFrame, threshold: float = SIMILAR, width: int = WIDTH
) -> DataFrame:
    """``(doc_id, item_id, n_shared, n_item, containment)`` for items of which
    at least ``threshold`` of the distinct shingles stand in a document.

    An item's MinHash sketch is its smallest shingle hashes. Items are
    partitioned by their number of shingles n, and the partition sets the
    sketch: floor((1 - threshold) n) + 1 values, of which a document that
    holds enough of the item must hold at least one whatever its own length.
    So the search misses none. Candidates are then verified on the shingles'
    words. An item of fewer than ``width`` words is one shingle of all its
    words. Documents or items without words match nothing, as do null ids;
    repeated rows count once. Other columns are ignored.
    """
    w = (
        items.filter("item_id is not null").select("item_id", words_of(F.col("text")).alias("words"))
        .filter(F.size("words") > 0)
        .withColumn("width", F.least(F.size("words"), F.lit(width)))
    )
    shingled = stored(
        w.select("item_id", "width", F.explode(F.array_distinct(
            shingles_at("words", F.col("width")))).alias("shingle")).distinct(), "items",
    )
    sizes = shingled.groupBy("item_id").agg(F.count(F.lit(1)).alias("n_item"))
    widths = [r[0] for r in shingled.select("width").distinct().collect()]  # at most `width` values
    hashed = None
    for k in widths:
        part = shingled.filter(F.col("width") == k).select(
            "item_id", "width", "shingle", item_hash(F.col("shingle"), k).alias("h"))
        hashed = part if hashed is None else hashed.unionByName(part)
    empty = "doc_id long, item_id long, n_shared long, n_item long, containment double"
    if hashed is None:
        return docs.sparkSession.createDataFrame([], empty)
    keep = F.floor((1 - threshold) * F.col("n_item") + 1e-9) + 1
    sketch = (
        hashed.groupBy("item_id").agg(F.sort_array(F.collect_set("h")).alias("hs"))
        .join(sizes, "item_id")
        .select("item_id", F.explode(F.slice("hs", F.lit(1), keep.cast("int"))).alias("h"))
    )
    sketch = stored(sketch, "sketch")
    probe = sketch.select("h").distinct()
    small = probe.count() <= BROADCAST_ROWS
    texts = docs.filter("doc_id is not null").select("doc_id", words_of(F.col("text")).alias("words"))
    hs = F.array_distinct(F.concat(*[hashes_at("words", k) for k in widths]))
    found = texts.select("doc_id", F.explode(hs).alias("h"))
    # The probe is one eight-byte number per row, so its row count bounds it.
    hits = found.join(F.broadcast(probe) if small else probe, "h")
    pairs = stored(hits.join(sketch, "h").select("doc_id", "item_id").distinct(), "pairs")
    again = texts.join(pairs.select("doc_id").distinct(), "doc_id", "left_semi")
    own = None
    for k in widths:
        part = again.select("doc_id", F.explode(F.array_distinct(
            shingles_at("words", F.lit(k)))).alias("shingle"))
        own = part if own is None else own.unionByName(part)
    # Shingles are texts of any length and number: Spark judges by their size.
    own = own.join(shingled.select("shingle").distinct(), "shingle", "left_semi")
    shared = (
        own.distinct().join(shingled, "shingle").join(pairs, ["doc_id", "item_id"])
        .groupBy("doc_id", "item_id").agg(F.count(F.lit(1)).alias("n_shared"))
    )
    return (
        shared.join(sizes, "item_id")
        .withColumn("containment", F.col("n_shared") / F.col("n_item"))
        .filter(F.col("containment") >= threshold - 1e-12)
        .select("doc_id", "item_id", "n_shared", "n_item", "containment")
    )


def decontaminate(docs: DataFrame, items: DataFrame, **settings) -> DataFrame:
    """The documents that hold no item; rows with a null id stay."""
    bad = contained(docs, items, **settings).select("doc_id").distinct()
    return docs.join(bad, "doc_id", "left_anti").select(*docs.columns)
