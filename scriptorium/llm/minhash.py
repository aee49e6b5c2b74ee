"""Near-dedup by BagMinHash signatures of shingle multisets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from scriptorium.llm.common import SIMILAR, WIDTH, components, stored, words_of
from scriptorium.llm.decontaminate import hashes_at

BANDS, ROWS, SALTS, CHUNK, BLOCK = 25, 5, 16, 128, 256
U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: equal input, equal output, on any machine."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
        return x ^ (x >> U(31))


def uniform(x: np.ndarray) -> np.ndarray:
    return ((x >> U(11)).astype(np.float64) + 0.5) / 2.0**53


def bag_signatures(doc: np.ndarray, element: np.ndarray, weight: np.ndarray, n: int, m: int):
    """``n x m`` signatures of bags given as (doc, element, weight) entries.

    Weights are cut into the intervals (0, 1], (1, 2], (2, 4], ... Each
    element and interval has a Poisson process of points (time, place in the
    interval, component), which depend on these two alone; points placed above
    the weight are thinned out. A component keeps its earliest point, so two
    bags agree in it with a chance of their weighted Jaccard similarity.
    Points are drawn up to a time by which all components are likely filled,
    and on, where they are not.
    """
    levels = [(doc, element, weight, np.zeros(len(doc), dtype=np.int64), np.ones(len(doc)))]
    low = 1
    while (above := weight > low).any():
        levels.append((doc[above], element[above], weight[above],
                       np.full(above.sum(), low), np.full(above.sum(), float(low))))
        low *= 2
    d, e, w, lo, wide = (np.concatenate(c) for c in zip(*levels))
    with np.errstate(over="ignore"):
        seed = mix(e.astype(U) + mix(lo.astype(U) + U(0x9E3779B97F4A7C15)))
    state = mix(seed)
    time = -np.log(uniform(state)) / (m * wide)
    until = (np.log(m) + 2.0) / np.bincount(d, np.minimum(wide, w - lo), n)
    first, sign = np.full(n * m, np.inf), np.zeros(n * m, dtype=U)
    while True:
        live = np.nonzero(time <= until[d])[0]
        while len(live):
            x = mix(state[live] ^ U(0xD6E8FEB86659FD93))
            fits = lo[live] + 1 + np.floor(uniform(mix(x)) * wide[live]) <= w[live]
            slot = (d[live] * m + (x % U(m)).astype(np.int64))[fits]
            when, name = time[live][fits], x[fits]
            order = np.lexsort((name, when, slot))
            slot, when, name = slot[order], when[order], name[order]
            lead = np.r_[True, slot[1:] != slot[:-1]] if len(slot) else np.array([], dtype=bool)
            slot, when, name = slot[lead], when[lead], name[lead]
            early = when < first[slot]
            first[slot[early]], sign[slot[early]] = when[early], name[early]
            with np.errstate(over="ignore"):
                state[live] = mix(state[live] + U(0x9E3779B97F4A7C15))
            time[live] += -np.log(uniform(state[live])) / (m * wide[live])
            live = live[time[live] <= until[d[live]]]
        short = np.isinf(first).reshape(n, m).any(axis=1)
        if not short.any():
            return sign.reshape(n, m)
        until = np.where(short, until * 2, until)


def bag_of(text: Column, width: int = WIDTH) -> Column:
    """Hashes of all word shingles, repeats included, sorted; a text of fewer
    words is one shingle of them all."""
    return F.transform(F.array(words_of(text)), lambda w: F.sort_array(F.when(
        F.size(w) >= width, F.transform(F.sequence(F.lit(0), F.size(w) - width), lambda i: F.xxhash64(
            *[F.get(w, i + k) for k in range(width)]))
    ).when(F.size(w) > 0, F.array(F.xxhash64(w))).otherwise(F.array().cast("array<bigint>"))))[0]


def entries(bags: list) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sorted bags end to end: ``(lengths, values, at, weights)``, ``at`` being
    where a new shingle begins and ``weights`` how often it repeats."""
    lengths = np.array([len(b) for b in bags])
    doc, value = np.repeat(np.arange(len(bags)), lengths), np.concatenate(bags)
    at = np.nonzero(np.r_[True, (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])])[0]
    return lengths, value, at, np.diff(np.r_[at, len(value)])


def signed(bags: DataFrame, bands: int, rows: int) -> DataFrame:
    """``(doc_id, node, size, keys)``: the band keys of each bag. Equal bags of
    one Arrow batch get them once, at the first; the others' are null."""
    m, kind = bands * rows, bags.schema["doc_id"].dataType.simpleString()

    def keys_of(arrays: list) -> list:
        lengths, value, at, weight = entries(arrays)
        doc = np.repeat(np.arange(len(arrays)), lengths)
        sign = bag_signatures(doc[at], value[at].view(U), weight, len(arrays), m)
        key = np.zeros((len(arrays), bands), dtype=U) + np.arange(1, bands + 1).astype(U)
        for r in range(rows):
            key = mix(key ^ sign.reshape(-1, bands, rows)[:, :, r])
        return list(key.view(np.int64))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            sizes = frame["bag"].map(len).to_numpy()
            first = np.nonzero((~frame["node"].duplicated()).to_numpy() & (sizes > 0))[0]
            keys: list = [None] * len(frame)
            for begin in range(0, len(first), CHUNK):
                some = first[begin : begin + CHUNK]
                bags = [np.asarray(frame["bag"].iat[i], dtype=np.int64) for i in some]
                for i, key in zip(some, keys_of(bags)):
                    keys[i] = key
            yield pd.DataFrame({
                "doc_id": frame["doc_id"], "node": frame["node"], "size": sizes,
                "keys": pd.Series(keys, index=frame.index, dtype=object)})

    return bags.mapInPandas(run, f"doc_id {kind}, node long, size int, keys array<long>")


def marked(bags: DataFrame) -> DataFrame:
    """``(node, size, marks)``: marks tell the repeats of a shingle apart, so
    multiset overlap is set overlap."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for begin in range(0, len(frame), CHUNK):
                part = frame.iloc[begin : begin + CHUNK]
                lengths, value, at, weight = entries(
                    [np.asarray(b, dtype=np.int64) for b in part["bag"]])
                repeat = (np.arange(len(value)) - np.repeat(at, weight)).astype(U)
                with np.errstate(over="ignore"):
                    marks = np.where(repeat == 0, value.view(U), mix(value.view(U) + mix(repeat)))
                yield pd.DataFrame({
                    "node": part["node"].to_numpy(), "size": lengths,
                    "marks": np.split(marks.view(np.int64), np.cumsum(lengths)[:-1])})

    return bags.mapInPandas(run, "node long, size int, marks array<long>")


def verified(pairs: DataFrame, nodes: DataFrame, least: float) -> DataFrame:
    """The pairs ``(a, b)`` whose multisets overlap enough. A node of many
    pairs is copied once per 256 of them, which split its pairs."""
    heavy = pairs.groupBy("b").agg(F.ceil(F.count(F.lit(1)) / 256).cast("int").alias("salts"))
    dealt = stored(pairs.join(heavy, "b").withColumn(
        "salt", F.pmod(F.xxhash64("a"), F.col("salts"))).select("a", "b", "salt"), "dealt")
    one = nodes.select("node", "size", "marks")
    left = dealt.join(one.select(F.col("node").alias("a"), F.col("marks").alias("ma")), "a")
    right = one.join(heavy, one["node"] == heavy["b"]).select(
        "b", F.explode(F.sequence(F.lit(0).cast("long"), (F.col("salts") - 1).cast("long"))).alias("salt"),
        F.col("marks").alias("mb"))
    both = left.join(right, ["b", "salt"])
    shared = F.size(F.array_intersect("ma", "mb"))
    return both.select("a", "b", (shared / (F.size("ma") + F.size("mb") - shared)).alias("s")).filter(
        F.col("s") >= least - 1e-12).select("a", "b")


def joined_roots(placed: DataFrame, nodes: DataFrame, least: float, block: int = BLOCK) -> DataFrame:
    """Pairs of roots ``(a, b)`` between which some nodes of one key are
    similar enough; ``placed`` has ``key, salt, node, size,
    root``.

    Within a key, nodes outside its most frequent root meet all its nodes,
    block by block. A task compares two blocks on the whole multisets and
    gives each pair of roots once, so pairs of nodes are never rows.
    """
    counts = placed.groupBy("key", "root").agg(
        F.count(F.lit(1)).alias("n"), F.min("size").alias("low"), F.max("size").alias("high"))
    # Two nodes alone on a key, too unlike in size to be similar, need no task.
    apart = (F.col("n") == 2) & (F.col("low") < (least - 1e-12) * F.col("high"))
    mixed = stored(counts.groupBy("key").agg(
        F.count(F.lit(1)).alias("roots"), F.sum("n").alias("n"), F.max("n").alias("top"),
        F.max_by("root", F.struct("n", "root")).alias("main"), F.min("low").alias("low"),
        F.max("high").alias("high")).filter("roots > 1").filter(~apart).select(
        "key", "main", F.ceil((F.col("n") - F.col("top")) / block).cast("int").alias("few"),
        F.ceil(F.col("n") / block).cast("int").alias("all")), "mixed")
    copied = mixed.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    open_ = stored(placed.join(copied, ["key", "salt"]).join(
        nodes.select("node", "marks"), "node").drop("salt"), "open")

    def own(blocks: str) -> Column:
        return F.pmod(F.xxhash64("node", F.lit("block")), F.col(blocks)).cast("int")

    def every(blocks: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(blocks) - 1))

    left = open_.filter("root <> main").select(
        "key", own("few").alias("i"), every("all").alias("j"), "root", "marks")
    right = open_.select(
        F.col("key").alias("to_key"), every("few").alias("to_i"), own("all").alias("to_j"),
        F.col("root").alias("to_root"), F.col("marks").alias("to_marks"))

    def meet(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        found: set[tuple[int, int]] = set()
        if len(a) and len(b):
            sizes = np.array([len(m) for m in b["to_marks"]])
            names, at = np.unique(np.concatenate(list(b["to_marks"])), return_inverse=True)
            starts, others = np.r_[0, np.cumsum(sizes)[:-1]], b["to_root"].to_numpy()
            for root, marks in zip(a["root"], a["marks"]):
                held = np.isin(names, marks).astype(np.int64)
                both = np.add.reduceat(held[at], starts)
                near = both / (len(marks) + sizes - both) >= least - 1e-12
                found.update((int(root), int(r)) for r in np.unique(others[near & (others != root)]))
        return pd.DataFrame(sorted(found), columns=["a", "b"]).astype("int64")

    met = left.groupBy("key", "i", "j").cogroup(right.groupBy("to_key", "to_i", "to_j"))
    return stored(met.applyInPandas(meet, "a long, b long").distinct(), "joined")


def with_node(rows: DataFrame) -> DataFrame:
    """``rows`` with ``bag``, the shingle multiset of ``text``, and ``node``,
    its hash. Texts without words are told apart as they are."""
    node = F.when(F.size("bag") > 0, F.xxhash64("bag")).otherwise(F.xxhash64(F.lit("raw"), F.col("text")))
    return rows.withColumn("bag", bag_of(F.col("text"))).withColumn("node", node)


def classed(
    docs: DataFrame, least: float = SIMILAR, bands: int = BANDS, rows: int = ROWS
) -> DataFrame:
    """``(doc_id, node, class_id, lead)`` per row with an id and a text:
    ``class_id`` and ``lead`` are the id and the node of the first row of its
    class, by id, then node.

    One pass over the texts writes ids, nodes and band keys only. Texts are
    read again, and their multisets kept, for nodes that share a key.
    """
    usable = docs.filter("doc_id is not null and text is not null").select("doc_id", "text")
    signs = stored(signed(with_node(usable).select("doc_id", "node", "bag"), bands, rows), "signs")
    keyed = signs.select("node", "size", F.explode("keys").alias("key"))
    shared = stored(
        keyed.groupBy("key").agg(F.min("node").alias("pivot"), F.max("node").alias("last"))
        .filter("pivot <> last").select("key", "pivot"), "shared")
    spread = keyed.withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(SALTS)).cast("int"))
    copied = shared.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    held = stored(
        spread.join(copied, ["key", "salt"]).select("key", "salt", "node", "size", "pivot").distinct(),
        "held")
    # One row of each node that shares a key stands for its text.
    heads = stored(
        signs.select("doc_id", "node").join(held.select("node").distinct(), "node", "left_semi")
        .groupBy("node").agg(F.min("doc_id").alias("doc_id")).select("doc_id").distinct(), "heads")
    bags = with_node(usable.join(heads, "doc_id", "left_semi")).filter(F.size("bag") > 0)
    nodes = stored(marked(bags.select("node", "bag").dropDuplicates(["node"])), "nodes")
    others = held.filter("node <> pivot")
    star = others.select(F.col("node").alias("a"), F.col("pivot").alias("b")).distinct()
    links = stored(verified(star, nodes, least), "star")
    roots = components(links)
    # The pivot has met all nodes of its key, so only the others are left.
    placed = stored(others.join(roots, others["node"] == roots["id"], "left").select(
        "key", "salt", "node", "size", F.coalesce("root", "node").alias("root")), "placed")
    links = links.unionByName(joined_roots(placed, nodes, least))
    roots = components(links)
    members = signs.select("doc_id", "node")
    named = members.groupBy("node").agg(F.min("doc_id").alias("doc_id")).join(
        roots, F.col("node") == roots["id"], "left").select(
        "doc_id", "node", F.coalesce("root", "node").alias("root"))
    classes = named.groupBy("root").agg(F.min(F.struct("doc_id", "node")).alias("first"))
    by_node = stored(
        named.select("node", "root").join(classes, "root").select(
            "node", F.col("first.doc_id").alias("class_id"), F.col("first.node").alias("lead"))
        .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))), "classes")
    return members.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int")).join(
        by_node, ["node", "salt"]).select("doc_id", "node", "class_id", "lead")


def near_duplicates(
    docs: DataFrame, least: float = SIMILAR, bands: int = BANDS, rows: int = ROWS
) -> DataFrame:
    """``(doc_id, class_id)`` per row: the smallest id of the documents joined
    to it by links of weighted Jaccard similarity ``least`` or more.

    Texts with equal shingle multisets are one node. Nodes of equal band key
    are first compared with the key's smallest node; then the key's other
    nodes that these links leave in different components are compared with
    each other in blocks (``joined_roots``). Pairs already joined by links
    need no comparison, so a large group of copies costs about one comparison
    per member. Each pair is verified on the whole multisets.

    Texts without words are compared as they are; a null text or id is in no
    group (its class is its own id). Repeated rows come back repeated. Other
    columns are ignored; an empty table gives no rows.
    """
    alone = docs.filter("doc_id is null or text is null").select("doc_id", F.col("doc_id").alias("class_id"))
    return classed(docs, least, bands, rows).select("doc_id", "class_id").unionByName(alone)


def keep_one(docs: DataFrame, **settings) -> DataFrame:
    """One row of each group of near duplicates, with all its columns.

    What stays is judged by row, not by id: of a group the row of the smallest
    id, and of the smallest node among texts of that id. A row whose id has
    another, grouped text stays if its own text is in no group or leads one.
    Of rows equal in id and multiset one stays, whichever comes first. Rows
    without an id or a text are in no group and all stay.

    Only rows of ids that lose a row are hashed again; all others pass through
    an anti join with those ids.
    """
    found = stored(classed(docs, **settings), "classed")
    leads = (F.col("doc_id") == F.col("class_id")) & (F.col("node") == F.col("lead"))
    again = found.filter(leads).groupBy("doc_id", "node").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    touched = stored(
        found.filter(~leads).select("doc_id").unionByName(again.select("doc_id")).distinct(), "touched")
    stay = found.filter(leads).select("doc_id", "node").distinct().join(touched, "doc_id", "left_semi")
    some = docs.join(touched, "doc_id", "left_semi")
    rows = with_node(some.filter("text is not null").select(
        "doc_id", "text", F.struct(*docs.columns).alias("row"))).select("doc_id", "node", "row")
    first = rows.join(stay, ["doc_id", "node"], "left_semi").dropDuplicates(["doc_id", "node"])
    return docs.join(touched, "doc_id", "left_anti").select(*docs.columns).unionByName(
        some.filter("text is null").select(*docs.columns)).unionByName(first.select("row.*"))
