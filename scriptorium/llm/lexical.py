"""Ranked lexical search: upper bounds from bit-sliced Bloom signatures, then exact scores."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from scriptorium.llm.common import stored

TOP = 10
HASHES, BITS, ROWS, CELLS = 4, 16, 512, 1 << 25  # CELLS: bits of one block's signatures at most
ITEM_BYTES = 16 << 20  # terms of the items searched at once
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
# A signature holds a term once per level that its count reaches: 1, 2, 3, 4, 6, 8, 12, 16, ...
LEVELS = np.array(sorted({1} | {b << i for i in range(62) for b in (2, 3)}), dtype=np.int64)[:120]
INDEX = ("ids array<long>, lengths array<long>, most array<long>, bits long, slices binary")


def terms_of(text: Column) -> Column:
    """Maximal runs of letters A-Z (lower-cased), digits and all beyond ASCII."""
    low = F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.filter(F.split(low, r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"), lambda w: w != "")


def _hashes(terms: Iterable[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, terms), dtype=np.uint64)


def _bit_places(hashes: np.ndarray, level: np.ndarray | int, bits: int) -> np.ndarray:
    """The ``HASHES`` rows of a signature for a term at a level."""
    h = hashes + np.asarray(level, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    step = (h >> np.uint64(32)) | np.uint64(1)
    start = h & np.uint64(0xFFFFFFFF)
    turns = np.arange(HASHES, dtype=np.uint64)
    return ((start[:, None] + turns * step[:, None]) % np.uint64(bits)).astype(np.int64)


def _size_class(entries: int) -> int:
    """Bits of a signature: ``BITS`` per entry, rounded up to 2^i or 3 * 2^i."""
    whole = max(8, 1 << (entries - 1).bit_length()) if entries > 1 else 8
    return BITS * (whole * 3 // 4 if entries <= whole * 3 // 4 else whole)


def build_blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents with signatures of one size make a block of up to ``ROWS``
    (fewer long ones); row i of its slices has bit i of all its documents."""
    open_: dict[int, list[tuple]] = {}
    held = 0

    def block(bits: int) -> pa.RecordBatch:
        nonlocal held
        docs = open_.pop(bits)
        held -= sum(len(d[3]) for d in docs)
        cells = np.zeros((bits, -(-len(docs) // 8) * 8), dtype=bool)
        for row, (_, _, most, hashes, reach) in enumerate(docs):
            for level in range(int(reach.max())):
                cells[_bit_places(hashes[reach > level], level, bits), row] = True
        return pa.RecordBatch.from_pylist([{
            "ids": [d[0] for d in docs], "lengths": [d[1] for d in docs], "most": [d[2] for d in docs],
            "bits": bits, "slices": np.packbits(cells, axis=1).tobytes()}], schema=pa.schema([
                ("ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())),
                ("most", pa.list_(pa.int64())), ("bits", pa.int64()), ("slices", pa.binary())]))

    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            words = _WORD.findall(text.lower())
            if not words:
                continue
            counts = Counter(words)
            often = np.fromiter(counts.values(), dtype=np.int64, count=len(counts))
            reach = np.searchsorted(LEVELS, often, side="right")
            bits = _size_class(int(reach.sum()))
            open_.setdefault(bits, []).append((doc_id, len(words), int(often.max()), _hashes(counts), reach))
            held += len(counts)
            if len(open_[bits]) >= max(8, min(ROWS, CELLS // bits)):
                yield block(bits)
            elif held > 4_000_000:
                yield block(max(open_, key=lambda b: b * len(open_[b])))
    for bits in list(open_):
        yield block(bits)


class ItemBlock:
    """The terms and weights of some items, ready for signatures. It goes to
    the tasks with their code, so its size is bounded by ``ITEM_BYTES``."""

    def __init__(self, items: dict[int, list[tuple[bytes, int]]]):
        names = sorted({term for terms in items.values() for term, _ in terms})
        place = {name: i for i, name in enumerate(names)}
        self.items, self.ids = items, list(items)
        self.hashes = _hashes(names) if names else np.zeros(0, np.uint64)
        self.terms = [np.array([place[t] for t, _ in terms], dtype=int) for terms in items.values()]
        self.weights = [np.array([w for _, w in terms], dtype=np.float64) for terms in items.values()]

    def bounds(self, lengths, most, bits: int, slices: bytes, n_docs: int, n_terms: int) -> np.ndarray:
        """Per item and document of a block a score that is not exceeded.

        Where a signature has the bits of a term up to a level, its count is at
        most one less than the next level. The contribution of that count to
        a score, per unit of weight, is the same for all terms of a document:
        so weights are summed per level, times what the level adds.
        """
        rows = np.frombuffer(slices, dtype=np.uint8).reshape(bits, -1)
        dampers = 8 * (25 + (75 * lengths * n_docs) // n_terms)
        sums = np.zeros((len(self.ids), len(lengths)), dtype=np.int64)
        alive = np.arange(len(self.hashes))
        shown = np.full((len(alive), rows.shape[1]), 255, dtype=np.uint8)
        before = np.zeros(len(lengths), dtype=np.int64)
        slot = np.full(len(alive), -1)
        for level in range(int(np.searchsorted(LEVELS, most.max(), side="right"))):
            places = _bit_places(self.hashes[alive], level, bits)
            shown = shown & np.bitwise_and.reduce(rows[places], axis=1)
            some = shown.any(axis=1)
            alive, shown = alive[some], shown[some]
            if not len(alive):
                break
            count = np.minimum(most, LEVELS[level + 1] - 1)
            worth = (1_000_000_000 * count) // (1000 * count + dampers)
            slot[:] = -1
            slot[alive] = np.arange(len(alive))
            present = np.unpackbits(shown, axis=1)[:, : len(lengths)].astype(np.float64)
            for i, (terms, weights) in enumerate(zip(self.terms, self.weights)):
                at = slot[terms]
                if (hit := at >= 0).any():
                    sums[i] += (weights[hit] @ present[at[hit]]).astype(np.int64) * (worth - before)
            before = worth
        return sums


def _bounded(block: ItemBlock, n_docs: int, n_terms: int, top: int | None, floors: dict[int, int]):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Documents not below an item's floor; with ``top`` only as many of a
        task, those with the highest bounds."""
        floor = np.array([[max(floors.get(i, 1), 1)] for i in block.ids], dtype=np.int64)
        best: list[list[tuple[int, int]]] = [[] for _ in block.ids]

        def rows(found: list[tuple]) -> pa.RecordBatch:
            cols = list(zip(*found)) if found else [[], [], []]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in cols], names=["item_id", "doc_id", "bound"])

        for batch in batches:
            for at in range(len(batch)):
                row = batch.slice(at, 1).to_pylist()[0]
                ids = np.array([i or 0 for i in row["ids"]], dtype=np.int64)
                bound = block.bounds(
                    np.array(row["lengths"]), np.array(row["most"]), row["bits"], row["slices"],
                    n_docs, n_terms)
                bound[:, [i is None for i in row["ids"]]] = 0
                if top is None:
                    item, doc = np.nonzero(bound >= floor)
                    yield rows(list(zip(
                        [block.ids[i] for i in item], ids[doc].tolist(), bound[item, doc].tolist())))
                    continue
                take = min(top, len(ids))
                for i, some in enumerate(np.argpartition(-bound, take - 1, axis=1)[:, :take]):
                    best[i] += [(int(bound[i, d]), int(ids[d])) for d in some if bound[i, d]]
                    best[i] = sorted(best[i], reverse=True)[:top]
        yield rows([(block.ids[i], d, b) for i, some in enumerate(best) for b, d in some])
    return run


def _scored(block: ItemBlock, n_docs: int, n_terms: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Exact scores of documents for the wanted items."""
        for batch in batches:
            out: list[tuple[int, int, int]] = []
            for row in batch.to_pylist():
                counts = Counter(_WORD.findall(row["text"].lower()))
                damper = 8 * (25 + (75 * counts.total() * n_docs) // n_terms)
                for item in row["wanted"]:
                    score = sum(
                        weight * ((1_000_000_000 * tf) // (1000 * tf + damper))
                        for term, weight in block.items[item] if (tf := counts.get(term)))
                    if score > 0:
                        out.append((item, row["doc_id"], score))
            cols = list(zip(*out)) if out else [[], [], []]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in cols], names=["item_id", "doc_id", "score"])
    return run


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The signatures of all documents that hold a term, stored."""
    texts = docs.filter(F.col(text_col).isNotNull()).select(
        F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    return stored(texts.mapInArrow(build_blocks, INDEX), "signatures")


def search(
    docs: DataFrame, items: DataFrame, top: int = TOP, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: per item the ``top`` documents with
    the highest score above 0, ties by smaller ids.

    Signatures bound every score from above. The exact scores of the documents
    with the highest bounds give each item a floor; every document whose bound
    is not below it is scored exactly. More items than ``ITEM_BYTES`` holds are
    searched group after group. Null texts hold no terms, as empty ones;
    an item or document without terms is in no row. The rows of one item_id are
    one text; each row of ``docs`` is a document, also where ids repeat. Rows
    with a null id are left out of the results but count in the statistics.
    Empty tables give no rows; other columns are not looked at.
    """
    spark = docs.sparkSession
    index = build_index(docs, id_col, text_col)
    total = index.agg(
        F.sum(F.size("ids")), F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x))).first()
    empty = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    if not total[0]:
        return empty
    n_docs, n_terms = int(total[0]), int(total[1])

    spelled = items.filter("item_id is not null").select("item_id", F.explode(terms_of(F.col("text"))).alias("term"))
    asked = stored(spelled.groupBy("item_id", "term").agg(F.count(F.lit(1)).alias("reps")), "terms")
    held = docs.select(F.explode(F.array_distinct(terms_of(F.col(text_col)))).alias("term"))
    df = held.join(asked.select("term").distinct(), "term").groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    weight = F.floor(1000 * F.log((F.lit(2.0 * n_docs + 2)) / (2 * F.col("df") + 1)))
    size = asked.agg(F.sum(F.octet_length("term") + 64)).first()[0]
    groups = -(-(size or 0) // ITEM_BYTES)
    weighed = stored(
        asked.join(df, "term").groupBy("item_id").agg(F.collect_list(F.struct(
            F.col("term").cast("binary").alias("term"), (weight * F.col("reps")).alias("weight"))).alias("terms")),
        "items")
    texts = docs.filter(F.col(text_col).isNotNull()).select(
        F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("text"))

    def first(rows: DataFrame, by: str) -> DataFrame:
        window = Window.partitionBy("item_id").orderBy(F.desc(by), "doc_id")
        return rows.withColumn("rank", F.row_number().over(window)).filter(F.col("rank") <= top)

    def ranked(group: int) -> DataFrame:
        """The search for the items of one group, which are about ``ITEM_BYTES``."""
        own = weighed.filter(F.pmod(F.xxhash64("item_id"), F.lit(groups)) == group)
        block = ItemBlock({r["item_id"]: [(bytes(t), w) for t, w in r["terms"]] for r in own.toLocalIterator()})

        def bounded(most: int | None, floors: dict[int, int], label: str) -> DataFrame:
            return stored(index.mapInArrow(
                _bounded(block, n_docs, n_terms, most, floors), "item_id long, doc_id long, bound long"), label)

        def scores(pairs: DataFrame) -> DataFrame:
            wanted = pairs.groupBy("doc_id").agg(F.collect_set("item_id").alias("wanted"))
            return first(
                texts.join(wanted, "doc_id").mapInArrow(
                    _scored(block, n_docs, n_terms), "item_id long, doc_id long, score long"), "score")

        likely = first(bounded(top, {}, "likely"), "bound")
        tried = scores(likely).groupBy("item_id").agg(
            F.count(F.lit(1)).alias("n"), F.min("score").alias("floor")).filter(F.col("n") >= top)
        floors = {r["item_id"]: r["floor"] for r in tried.collect()}  # one number per item of the group
        return scores(bounded(None, floors, "candidates"))

    found = empty
    for group in range(groups):
        found = found.unionByName(ranked(group).select(
            "item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score"))
    return found
