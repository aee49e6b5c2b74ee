"""Nearest neighbours by inner product: a k-means tree, searched best bin first."""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from scriptorium.llm.common import stored

K, RECALL = 20, 0.93
SAMPLE, BRANCHES, LEAF = 32_768, 16, 32  # the tree is fitted on at most SAMPLE vectors
PROBES = 256  # queries with exact answers, on which the number of leaves is set
BIN_ROWS, BIN_QUERIES = 65_536, 4_096


@dataclass
class Tree:
    """Centres of all nodes; ``children`` of a leaf is empty. Node 0 is the root."""

    centers: np.ndarray
    children: list[list[int]]

    def leaf_of(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf reached by going to the nearest centre on each level."""
        leaf = np.zeros(len(vectors), dtype=np.int64)
        todo = [(0, np.arange(len(vectors)))]
        while todo:
            node, rows = todo.pop()
            if not self.children[node] or not len(rows):
                leaf[rows] = node
                continue
            below = np.array(self.children[node])
            nearest = below[_nearest(vectors[rows], self.centers[below])]
            todo += [(int(b), rows[nearest == b]) for b in below]
        return leaf

    def leaves_in_order(self, products: np.ndarray, visits: int) -> list[int]:
        """Best bin first: the open node with the largest product with the
        query is taken next; a leaf is visited, another node opens its children."""
        queue, order = [(0.0, 0)], []
        while queue and len(order) < visits:
            _, node = heapq.heappop(queue)
            below = self.children[node]
            if not below:
                order.append(node)
            for child in below:
                heapq.heappush(queue, (-products[child], child))
        return order


def _nearest(vectors: np.ndarray, centers: np.ndarray) -> np.ndarray:
    return np.argmax(vectors @ centers.T - (centers * centers).sum(1) / 2, axis=1)


def fit_tree(vectors: np.ndarray, branches: int = BRANCHES, leaf: int = LEAF, rounds: int = 8) -> Tree:
    """Hierarchical k-means: a node of more than ``leaf`` vectors is cut into
    up to ``branches`` clusters, as long as its vectors differ."""
    dice = np.random.default_rng(13)
    tree = Tree(vectors.mean(axis=0, keepdims=True), [[]])
    centers = [tree.centers[0]]
    todo = [(0, np.arange(len(vectors)))]
    while todo:
        node, rows = todo.pop()
        if len(rows) <= leaf:
            continue
        part = vectors[rows]
        seeds = np.unique(part[dice.permutation(len(part))[: 4 * branches]], axis=0)
        middle = dice.permutation(seeds)[: min(branches, len(rows) // leaf + 1)]
        for _ in range(rounds):
            own = _nearest(part, middle)
            counts = np.bincount(own, minlength=len(middle))
            sums = np.zeros_like(middle)
            np.add.at(sums, own, part)
            middle = sums[counts > 0] / counts[counts > 0, None]
        own = _nearest(part, middle)
        used = np.unique(own)
        if len(used) < 2:
            continue
        for cluster in used:
            tree.children[node].append(len(centers))
            todo.append((len(centers), rows[own == cluster]))
            tree.children.append([])
            centers.append(middle[cluster])
    tree.centers = np.array(centers)
    return tree


class Best:
    """The top ``k`` (larger scores, then smaller ids) per query over many blocks.

    A matrix product finds who comes into question, with a margin for its
    rounding: only what reaches the k-th score held so far. Those products are
    then summed in order of the components, so that equal vectors get equal
    scores wherever they are.
    """

    def __init__(self, queries: np.ndarray, query_ids: np.ndarray, k: int):
        self.queries, self.query_ids, self.k = queries, query_ids, k
        self.held = [np.zeros(0, int), np.zeros(0), np.zeros(0, int), np.zeros(0, int)]
        self.new: list[tuple[np.ndarray, ...]] = []
        self.waiting = 0
        self.edge = np.full(len(queries), -np.inf)
        self.length = np.abs(queries).sum(axis=1)

    def offer(self, own: np.ndarray, vectors: np.ndarray, ids: np.ndarray, tags: np.ndarray) -> None:
        """Rows that the queries with the numbers ``own`` shall look at; a tag
        is kept with its row."""
        slack = 4 * vectors.shape[1] * np.finfo(float).eps * np.abs(vectors).max(initial=0.0)
        step = max(1, 2_000_000 // max(len(ids), 1))
        for begin in range(0, len(own), step):
            part = own[begin : begin + step]
            rough = self.queries[part] @ vectors.T
            rough[self.query_ids[part, None] == ids[None, :]] = np.nan
            least = self.edge[part]
            if len(ids) > self.k:
                top = np.partition(np.nan_to_num(rough, nan=-np.inf), len(ids) - self.k, axis=1)
                least = np.maximum(least, top[:, len(ids) - self.k])
            q, r = np.nonzero(rough >= (least - slack * self.length[part])[:, None])
            for at in range(0, len(q), 100_000):
                i, j = part[q[at : at + 100_000]], r[at : at + 100_000]
                score = np.cumsum(self.queries[i] * vectors[j], axis=1)[:, -1]
                self.new.append((i, score, ids[j], tags[j]))
                self.waiting += len(i)
                if self.waiting > 500_000:
                    self.merge()

    def merge(self) -> list[np.ndarray]:
        """Query number, score, id and tag of the rows held, in order."""
        if self.new:
            q, score, ids, tags = (np.concatenate(x) for x in zip(self.held, *self.new))
            order = np.lexsort((ids, -score, q))
            q, score, ids, tags = q[order], score[order], ids[order], tags[order]
            place = np.arange(len(q)) - np.searchsorted(q, q)
            keep = place < self.k
            self.held, self.new, self.waiting = [q[keep], score[keep], ids[keep], tags[keep]], [], 0
            last = place == self.k - 1
            self.edge[q[last]] = score[last]
        return self.held


def _matrix(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def usable(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``(id, vector, dim)`` of vectors that are not null, empty or zero and
    hold only finite components."""
    number = lambda x: x.cast("double")
    finite = F.forall(
        vector_col, lambda x: F.coalesce(F.abs(number(x)) < float("inf"), F.lit(False)) & ~F.isnan(number(x)))
    fit = finite & F.exists(vector_col, lambda x: number(x) != 0)
    return rows.filter(F.col(id_col).isNotNull() & F.coalesce(fit, F.lit(False))).select(
        F.col(id_col).alias("id"), F.col(vector_col).alias("vector"), F.size(vector_col).alias("dim"))


def _drawn(rows: DataFrame, count: int, of: int) -> DataFrame:
    """At most ``count`` rows by the hash of their id; ``of``: rows there are."""
    dice = F.xxhash64("id", F.lit(13))
    share = min(1.0, 2.0 * count / max(of, 1))
    narrow = rows.filter(F.pmod(dice, F.lit(1 << 30)) <= share * (1 << 30))
    return narrow.orderBy(dice, "id").limit(count)


def _indexed(rows: DataFrame, tree: Tree, dim: int) -> DataFrame:
    """``(id, vector, leaf)``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf = tree.leaf_of(_matrix(batch.column(1), dim))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(leaf, pa.int32())], names=["id", "vector", "leaf"])

    schema = T.StructType([*rows.schema.fields, T.StructField("leaf", T.IntegerType())])
    return rows.mapInArrow(run, schema)


def _probe_answers(index: DataFrame, probes: np.ndarray, probe_ids: np.ndarray, dim: int, k: int):
    """The leaves of the exact neighbours of the probes, by one pass over all
    rows: a task keeps the best ``k`` per probe."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, every = Best(probes, probe_ids, k), np.arange(len(probes))
        for batch in batches:
            best.offer(every, _matrix(batch.column(1), dim), batch.column(0).to_numpy(), batch.column(2).to_numpy())
        probe, score, ids, leaf = best.merge()
        yield pa.RecordBatch.from_arrays(
            [pa.array(probe, pa.int32()), pa.array(ids, pa.int64()), pa.array(leaf, pa.int32()),
             pa.array(score, pa.float64())], names=["probe", "id", "leaf", "score"])

    best = index.mapInArrow(run, "probe int, id long, leaf int, score double")
    window = Window.partitionBy("probe").orderBy(F.desc("score"), "id")
    best = best.withColumn("rank", F.row_number().over(window)).filter(F.col("rank") <= k)
    return [(r["probe"], r["leaf"]) for r in best.select("probe", "leaf").collect()]  # PROBES x k


def calibrate(tree: Tree, probes: np.ndarray, answers: list[tuple[int, int]], recall: float) -> int:
    """The fewest leaves to visit with which the probes' neighbours are found
    at a rate of at least ``recall``. The number of visits is doubled until
    that holds; the places of the leaves then tell the fewest."""
    n_leaves = sum(not c for c in tree.children)
    products = probes @ tree.centers.T
    visits = 1
    while True:
        places = [
            {leaf: i for i, leaf in enumerate(tree.leaves_in_order(p, visits))} for p in products]
        at = np.sort([places[q].get(leaf, n_leaves) + 1 for q, leaf in answers])
        if not len(at) or visits >= n_leaves or np.mean(at <= visits) >= recall:
            break
        visits = min(2 * visits, n_leaves)
    if not len(at):
        return n_leaves
    return int(min(at[int(np.ceil(recall * len(at))) - 1], n_leaves))


def _bins(index: DataFrame) -> dict[int, tuple[int, int]]:
    """Per leaf its first bin and how many: small neighbouring leaves share
    one, a large one has several. One number per leaf of the tree comes here."""
    out, bin_, filled = {}, 0, 0
    counts = index.groupBy("leaf").count().orderBy("leaf").collect()
    for leaf, count in counts:
        parts = -(-count // BIN_ROWS)
        if parts > 1 or filled + count > BIN_ROWS:
            bin_, filled = bin_ + (filled > 0), 0
        out[leaf] = (bin_, parts)
        if parts > 1:
            bin_ += parts
        else:
            filled += count
    return out


def _visits(queries: DataFrame, tree: Tree, visits: int, bins: dict[int, tuple[int, int]], dim: int) -> DataFrame:
    """``(id, vector, bin, leaves)``: each query once per bin it looks into."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            products = _matrix(batch.column(1), dim) @ tree.centers.T
            rows, at, leaves = [], [], []
            for i, product in enumerate(products):
                wanted: dict[int, list[int]] = {}
                for leaf in tree.leaves_in_order(product, visits):
                    first, parts = bins.get(leaf, (0, 0))
                    for b in range(first, first + parts):
                        wanted.setdefault(b, []).append(leaf)
                rows += [i] * len(wanted)
                at += wanted
                leaves += wanted.values()
            took = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(took), batch.column(1).take(took), pa.array(at, pa.int64()),
                 pa.array(leaves, pa.list_(pa.int32()))], names=["id", "vector", "bin", "leaves"])

    schema = T.StructType([
        *queries.schema.fields, T.StructField("bin", T.LongType()),
        T.StructField("leaves", T.ArrayType(T.IntegerType()))])
    return queries.mapInArrow(run, schema)


def _meet(dim: int, k: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def run(rows: pa.Table, queries: pa.Table) -> pa.Table:
        """The best of one bin for one block of queries."""
        query_ids = queries["id"].to_numpy() if queries.num_rows else np.zeros(0, int)
        best = Best(_matrix(queries["vector"], dim) if len(query_ids) else np.zeros((0, dim)), query_ids, k)
        if rows.num_rows and len(query_ids):
            ids, leaf, vectors = rows["id"].to_numpy(), rows["leaf"].to_numpy(), _matrix(rows["vector"], dim)
            wanted = queries["leaves"].combine_chunks()
            asker = np.repeat(np.arange(len(query_ids)), wanted.value_lengths().to_numpy())
            asked = wanted.flatten().to_numpy()
            by_leaf, by_row = np.argsort(asked, kind="stable"), np.argsort(leaf, kind="stable")
            for x in np.unique(leaf):
                own = asker[by_leaf[slice(*np.searchsorted(asked, [x, x + 1], sorter=by_leaf))]]
                at = by_row[slice(*np.searchsorted(leaf, [x, x + 1], sorter=by_row))]
                if len(own):
                    best.offer(own, vectors[at], ids[at], ids[at])
        query, score, found, _ = best.merge()
        return pa.table({
            "query_id": pa.array(query_ids[query], pa.int64()), "vec_id": pa.array(found, pa.int64()),
            "score": pa.array(score, pa.float64())})
    return run


def _search(rows: DataFrame, queries: DataFrame, dim: int, k: int, recall: float) -> DataFrame:
    count = rows.count()
    sample = np.array([r["vector"] for r in _drawn(rows, SAMPLE, count).collect()], dtype=np.float64)
    tree = fit_tree(sample)
    placed = _indexed(rows.select("id", "vector"), tree, dim)
    # Of equal vectors only the k + 1 with the smallest ids can be among any
    # query's k nearest (one may be the query itself); tasks cut the others
    # before the shuffle, so copies make no large leaf.
    copies = Window.partitionBy("leaf", "vector").orderBy("id")
    index = stored(
        placed.withColumn("copy", F.dense_rank().over(copies)).filter(F.col("copy") <= k + 1)
        .drop("copy").distinct(), "index")
    queries = queries.select("id", "vector")
    drawn = _drawn(queries, PROBES, queries.count()).collect()
    probes = np.array([r["vector"] for r in drawn], dtype=np.float64).reshape(-1, dim)
    answers = _probe_answers(index, probes, np.array([r["id"] for r in drawn]), dim, k)
    visits = calibrate(tree, probes, answers, recall)
    bins = _bins(index)
    asked = stored(_visits(queries, tree, visits, bins, dim), "visits")
    blocks = asked.groupBy("bin").agg(F.ceil(F.count(F.lit(1)) / BIN_QUERIES).cast("int").alias("blocks"))
    places = rows.sparkSession.createDataFrame(
        [(leaf, *where) for leaf, where in bins.items()], "leaf int, first long, parts int")
    dealt = (
        index.join(F.broadcast(places), "leaf")  # at most one row per leaf
        .withColumn("bin", F.col("first") + F.pmod(F.xxhash64("id"), F.col("parts")))
        .select("id", "vector", "leaf", "bin"))
    left = dealt.join(blocks, "bin").select(
        "id", "vector", "leaf", "bin", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    right = asked.join(blocks, "bin").select(
        "id", "vector", "leaves", F.col("bin").alias("to_bin"),
        F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int").alias("to_block"))
    met = left.groupBy("bin", "block").cogroup(right.groupBy("to_bin", "to_block"))
    return met.applyInArrow(_meet(dim, k), "query_id long, vec_id long, score double")


def nearest(
    rows: DataFrame, queries: DataFrame, k: int = K, recall: float = RECALL,
    id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: about the ``k`` rows with the largest
    inner product per query, other than those with the query's id.

    The tree is fitted on at most ``SAMPLE`` vectors; all rows are indexed. How
    many leaves a query visits is calibrated on at most ``PROBES`` queries with
    exact answers, so that ``recall`` of their neighbours are found. Scores are
    exact, in double precision, summed in order of the components; ties go to
    smaller ids. Vectors that are null, empty, zero or hold null or non-finite
    components, and rows without an id, take no part. A repeated row counts
    once; rows with one id and different vectors count as one with its best
    score. Vectors meet those of their own length. Empty tables give no rows;
    other columns are not looked at.
    """
    rows, queries = usable(rows, id_col, vector_col), usable(queries, id_col, vector_col)
    dims = [r["dim"] for r in queries.select("dim").distinct().collect()]  # lengths, not vectors
    found = rows.sparkSession.createDataFrame([], "query_id long, vec_id long, score double")
    for dim in sorted(dims):
        some, asked = rows.filter(F.col("dim") == dim), queries.filter(F.col("dim") == dim)
        if not some.isEmpty():
            found = found.unionByName(_search(some.drop("dim"), asked.drop("dim"), dim, k, recall))
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    window = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(window)).filter(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
