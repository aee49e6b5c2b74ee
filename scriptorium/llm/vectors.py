"""Embedding near-dedup by sorted projection passes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from scriptorium.llm.common import components, stored

COSINE, PASSES, BITS, WINDOW, BLOCK = 0.95, 16, 32, 64, 2048


def hash_keys(vectors: np.ndarray, passes: int, bits: int) -> np.ndarray:
    """Per vector and pass, the signs of ``bits`` random projections as one
    number: order by it is lexicographic order by the signs."""
    plan = np.random.default_rng(20240229).standard_normal((vectors.shape[1], passes * bits))
    signs = (vectors @ plan > 0).reshape(len(vectors), passes, bits)
    return signs @ (1 << np.arange(bits - 1, -1, -1, dtype=np.int64))


def window_pairs(ids, vecs, new_from: int, window: int, least: float):
    """Pairs of rows at most ``window`` apart, the later at ``new_from`` or on."""
    a_all, b_all = [], []
    for step in range(1, min(window, len(ids) - 1) + 1):
        low = max(new_from - step, 0)
        cos = np.einsum("ij,ij->i", vecs[low : len(ids) - step], vecs[low + step :])
        at = np.nonzero(cos >= least)[0] + low
        a_all.append(ids[at])
        b_all.append(ids[at + step])
    if not a_all:
        return np.array([], dtype=np.int64), np.array([], dtype=np.int64)
    a, b = np.concatenate(a_all), np.concatenate(b_all)
    return np.minimum(a, b), np.maximum(a, b)


def units(column) -> np.ndarray:
    vecs = np.array(column.tolist(), dtype=np.float64)
    vecs /= np.abs(vecs).max(axis=1, keepdims=True)
    return vecs / np.linalg.norm(vecs, axis=1, keepdims=True)


def counted(members: DataFrame, least: float, block: int = BLOCK) -> DataFrame:
    """``(class, beyond)``: per class of a component how many vectors of its
    other classes link with it. This finds the links that the windows of a
    dense component pass over. A component is cut into blocks by hash; two
    blocks meet in a task, which gives counts, never pairs."""
    cut = members.groupBy("root").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
    dealt = members.join(cut, "root").withColumn("own", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int"))
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    left = dealt.select("root", "class", "embedding", F.col("own").alias("i"), every.alias("j"))
    right = dealt.select(
        F.col("root").alias("to_root"), F.col("class").alias("to"), F.col("n").alias("to_n"),
        F.col("embedding").alias("to_embedding"), F.col("own").alias("to_j"), every.alias("to_i"))

    def meet(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if a.empty or b.empty:
            return pd.DataFrame({"class": [], "beyond": []}).astype("int64")
        x, y, n = units(a["embedding"]), units(b["to_embedding"]), b["to_n"].to_numpy()
        out = np.zeros(len(a), dtype=np.int64)
        for begin in range(0, len(a), 256):
            part = slice(begin, begin + 256)
            near = x[part] @ y.T >= least
            near &= a["class"].to_numpy()[part, None] != b["to"].to_numpy()[None, :]
            out[part] = near @ n
        return pd.DataFrame({"class": a["class"].to_numpy(), "beyond": out})

    met = left.groupBy("root", "i", "j").cogroup(right.groupBy("to_root", "to_i", "to_j"))
    return met.applyInPandas(meet, "class long, beyond long").groupBy("class").agg(
        F.sum("beyond").alias("beyond"))


def near_vectors(
    rows: DataFrame, least: float = COSINE, passes: int = PASSES, bits: int = BITS,
    window: int = WINDOW,
) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` per row of ``rows (vec_id, embedding)``.

    Equal vectors are one class, its number the smallest ``vec_id``; every
    class is put in the order of each pass and compared, in double precision,
    with its ``window`` neighbours there. Pairs of all passes are united into
    components; inside a component all links are then counted, in blocks. Windows reach
    across the bounds of partitions. Vectors that are null, empty, zero or
    hold null or non-finite components link with nothing, nor do vectors of
    another length. Rows with a repeated ``vec_id`` are one vector if equal;
    null ids come back without links.
    """
    spark = rows.sparkSession
    v = F.col("embedding")
    sound = (
        F.col("vec_id").isNotNull() & v.isNotNull() & (F.size(v) > 0)
        & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists(v, lambda x: x != 0)
    )
    marked = rows.select(
        "vec_id", F.when(F.coalesce(sound, F.lit(False)), F.sha2(F.to_json(F.struct(
            F.transform(v, lambda x: x + F.lit(0.0).cast("float")).alias("v"))), 256)).alias("digest"), v.alias("embedding"))
    whole = marked.filter("digest is not null")
    classes = stored(
        whole.groupBy("digest").agg(
            F.min("vec_id").alias("class"), F.count_distinct("vec_id").alias("n"),
            F.first("embedding").alias("embedding"),
        ).withColumn("class_key", F.xxhash64("digest")), "classes")

    def keyed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for size, part in frame.groupby(frame["embedding"].map(len)):
                vecs = np.array(part["embedding"].tolist(), dtype=np.float64)
                vecs /= np.abs(vecs).max(axis=1, keepdims=True)
                keys = hash_keys(vecs, passes, bits)
                for at in range(passes):
                    yield pd.DataFrame({
                        "size": int(size), "pass": at, "key": keys[:, at],
                        "class": part["class"].to_numpy(), "embedding": part["embedding"].to_numpy()})

    ordered = (
        classes.select("class", "embedding")
        .mapInPandas(keyed, "size int, pass int, key long, class long, embedding array<float>")
        .repartitionByRange("size", "pass", "key", "class")
        .sortWithinPartitions("size", "pass", "key", "class")
    )

    def pair_frame(a, b):
        return pd.DataFrame({"a": a, "b": b, "edge": pd.Series([None] * len(a), dtype="object"),
                             "at": 0, "size": 0, "pass": 0, "embedding": None})

    def edge_frame(frame, part, places):
        return pd.DataFrame({"a": frame["class"].to_numpy(), "b": 0, "edge": part, "at": places,
                             "size": frame["size"].to_numpy(), "pass": frame["pass"].to_numpy(),
                             "embedding": frame["embedding"].to_numpy()})

    def compared(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        part, held, seen = TaskContext.get().partitionId(), None, 0
        for frame in frames:
            if seen < window and len(frame):  # the first rows meet the partition before
                head = frame.head(window - seen)
                yield edge_frame(head, part, range(window + seen, window + seen + len(head)))
            seen += len(frame)
            both = frame if held is None else pd.concat([held, frame], ignore_index=True)
            fresh = 0 if held is None else len(held)
            for key, span in both.groupby(["size", "pass"], sort=False).indices.items():
                a, b = window_pairs(
                    both["class"].to_numpy()[span], units(both["embedding"].iloc[span]),
                    int((span < fresh).sum()), window, least)
                yield pair_frame(a, b)
            held = both.tail(window)
        if held is not None:  # the last rows meet the partition after
            yield edge_frame(held, part + 1, range(window - len(held), window))

    found = stored(ordered.mapInPandas(
        compared,
        "a long, b long, edge long, at long, size int, pass int, embedding array<float>"), "found")

    def bridged(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("at")
        old = int((group["at"] < window).sum())
        a, b = window_pairs(group["a"].to_numpy(), units(group["embedding"]), old, window, least)
        return pd.DataFrame({"a": a, "b": b})

    bridges = found.filter("edge is not null").groupBy("edge", "size", "pass").applyInPandas(
        bridged, "a long, b long")
    pairs = stored(
        found.filter("edge is null").select("a", "b").unionByName(bridges)
        .filter("a <> b").distinct(), "pairs")
    roots = stored(components(pairs).withColumnRenamed("id", "class"), "roots")
    links = counted(classes.join(roots, "class").select("root", "class", "n", "embedding"), least)
    known = stored(classes.select("digest", "class", "n").join(links, "class", "left").join(roots, "class", "left").select(
        "digest", (F.col("n") - 1 + F.coalesce("beyond", F.lit(0))).alias("n_links"),
        F.coalesce("root", "class").alias("component_id")), "known")
    # The class of a row is found through its digest; salted, as one class may
    # hold a third of all rows.
    salts = 16
    spread = marked.select("vec_id", "digest").withColumn(
        "salt", F.pmod(F.xxhash64("vec_id"), F.lit(salts)).cast("int"))
    many = known.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return spread.join(many, ["digest", "salt"], "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
        F.coalesce(F.coalesce("component_id", "vec_id") == F.col("vec_id"), F.lit(True)).alias("kept"))
