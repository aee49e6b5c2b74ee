"""LM scoring by cross-entropy difference of two n-gram models."""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from scriptorium.llm.common import stored
from scriptorium.llm.hashed import bucketed, mixed, pack, pair_hashes, unpack, word_hashes
from scriptorium.llm.phrases import pack_ids, unpack_ids

SMOOTH, DRAWS, SHARD_WORDS = 0.1, 1 << 32, 1 << 21
WORD = re.compile(r"\w+|[^\w\s]")
CONTEXT, BIGRAM = 1, 2
SHARD = pa.schema([
    ("shard", pa.int64()), ("docs", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64())),
    ("words", pa.binary()), ("ids", pa.binary())])
CHUNK = pa.schema([
    ("kind", pa.int32()), ("bucket", pa.int64()), ("shard", pa.int64()), ("hashes", pa.binary()),
    ("tg", pa.binary()), ("bg", pa.binary())])
MORE = pa.schema([
    ("of", pa.int64()), ("kind", pa.int32()), ("bucket", pa.int64()), ("tg", pa.binary()), ("bg", pa.binary())])
LOSS = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("t", pa.float64()), ("b", pa.float64())])


def cut_shards(batches: Iterable[pa.RecordBatch], limit: int = SHARD_WORDS) -> Iterator[pa.RecordBatch]:
    """Texts to shards of about ``limit`` words: ids and lengths of the texts,
    the distinct words, and all words as numbers from 1 into those. Shards are
    numbered by task and order."""
    context = TaskContext.get()
    numbers = itertools.count((context.partitionId() if context else 0) << 32)
    docs, sizes, parts, known, held = [], [], [], {"": 0}, 0

    def written() -> pa.RecordBatch:
        words = " ".join(itertools.islice(known, 1, None)).encode("utf-8", "surrogatepass")
        return pa.RecordBatch.from_pylist([{
            "shard": next(numbers), "docs": docs, "sizes": sizes, "words": zstandard.compress(words),
            "ids": pack_ids(np.concatenate(parts))}], schema=SHARD)

    for batch in batches:
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            words = WORD.findall((text.as_py() or "").lower())
            for word in set(words).difference(known):
                known[word] = len(known)
            docs.append(doc)
            sizes.append(len(words))
            parts.append(np.fromiter(map(known.__getitem__, words), dtype=np.int32, count=len(words)))
            held += len(words)
            if held >= limit:
                yield written()
                docs, sizes, parts, known, held = [], [], [], {"": 0}, 0
    if docs:
        yield written()


class Grams:
    """Contexts and bigrams of a shard. A text begins with a start mark, which
    is a context only and the word 0."""

    def __init__(self, row: dict):
        ids, sizes = unpack_ids(row["ids"]), np.array(row["sizes"], dtype=np.int64)
        self.texts = len(sizes)
        self.row = np.repeat(np.arange(self.texts), sizes)
        before = np.roll(ids, 1)
        before[(np.cumsum(sizes) - sizes)[sizes > 0]] = 0
        width = int(ids.max(initial=0)) + 1
        contexts, context = np.unique(before, return_inverse=True)
        pairs, pair = np.unique(before * width + ids, return_inverse=True)
        self.distinct = {CONTEXT: contexts, BIGRAM: pairs}
        self.gram, self.width, self.words = {CONTEXT: context, BIGRAM: pair}, width, row["words"]

    def counts(self, kind: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row of the text, gram and count of the distinct grams of each text."""
        size = max(len(self.distinct[kind]), 1)
        key, count = np.unique(self.row * size + self.gram[kind], return_counts=True)
        return key // size, key % size, count

    def held(self, kind: int, member: np.ndarray) -> np.ndarray:
        """Per gram its count in the texts that are members."""
        return np.bincount(
            self.gram[kind], weights=member[self.row], minlength=len(self.distinct[kind])).astype(np.int64)

    def hashes(self, kind: int) -> np.ndarray:
        """Per gram a hash of its words, the same in all shards."""
        words = ["", *zstandard.decompress(self.words).decode("utf-8", "surrogatepass").split(" ")]
        own = word_hashes(words)
        if kind == CONTEXT:
            return mixed(own[self.distinct[kind]])
        v, w = np.divmod(self.distinct[kind], self.width)
        return pair_hashes(own[v], own[w])


def _contexts(buckets: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(len(batch)):
                found = bucketed(Grams(batch.slice(at, 1).to_pylist()[0]).hashes(CONTEXT), buckets)
                rows = [{"bucket": bucket, "hashes": packed} for bucket, _, packed in found]
                yield pa.RecordBatch.from_pylist(
                    rows, schema=pa.schema([("bucket", pa.int64()), ("hashes", pa.binary())]))
    return run


def _distinct(chunks: pa.Table) -> pa.Table:
    found = np.unique(np.concatenate([np.cumsum(unpack(x.as_py())) for x in chunks["hashes"]]))
    return pa.table({"n": pa.array([len(found)], pa.int64())})


def _members(flags: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Per text of a shard whether it is in the target model, and in the background's."""
    order = np.argsort(flags["pos"].to_numpy())
    return flags["in_tg"].to_numpy()[order], flags["in_bg"].to_numpy()[order]


def _counted(buckets: int):
    def run(shard: pa.Table, flags: pa.Table) -> pa.Table:
        """The grams of a shard by bucket, with their counts in both models."""
        row, rows = shard.to_pylist()[0], []
        grams, (target, background) = Grams(row), _members(flags)
        for kind in (CONTEXT, BIGRAM):
            tg, bg = grams.held(kind, target), grams.held(kind, background)
            rows += [
                {"kind": kind, "bucket": bucket, "shard": row["shard"], "hashes": packed,
                 "tg": pack(tg[at]), "bg": pack(bg[at])}
                for bucket, at, packed in bucketed(grams.hashes(kind), buckets)]
        return pa.Table.from_pylist(rows, schema=CHUNK)
    return run


def _summed(chunks: pa.Table) -> pa.Table:
    """Of each shard's chunk of a bucket, the counts of its grams over all shards."""
    hashes = [np.cumsum(unpack(x.as_py())) for x in chunks["hashes"]]
    _, gram = np.unique(np.concatenate(hashes), return_inverse=True)
    cuts, out = np.cumsum([len(x) for x in hashes])[:-1], {}
    for model in ("tg", "bg"):
        counts = np.concatenate([unpack(x.as_py()) for x in chunks[model]])
        total = np.bincount(gram, weights=counts).astype(np.int64)[gram]
        # What other shards hold is mostly nothing or little.
        out[model] = [pack(x) for x in np.split(total - counts.astype(np.int64), cuts)]
    return pa.table([chunks["shard"], chunks["kind"], chunks["bucket"],
                     pa.array(out["tg"], pa.binary()), pa.array(out["bg"], pa.binary())], schema=MORE)


def _losses(buckets: int, alpha: float, v: int):
    def run(shard: pa.Table, right: pa.Table) -> pa.Table:
        """Per text with words: its id, words, and loss by both models."""
        row = shard.to_pylist()[0]
        grams = Grams(row)
        flags = right.filter(right["pos"].is_valid())
        members = dict(zip(("tg", "bg"), _members(flags)))
        more = {(x["kind"], x["bucket"]): x for x in right.filter(right["pos"].is_null()).to_pylist()}
        loss = {model: np.zeros(grams.texts) for model in members}
        for kind, sign, pseudo in ((CONTEXT, 1.0, alpha * v), (BIGRAM, -1.0, alpha)):
            places = [(bucket, at) for bucket, at, _ in bucketed(grams.hashes(kind), buckets)]
            text, gram, count = grams.counts(kind)
            for model, member in members.items():
                total = grams.held(kind, member)
                for bucket, at in places:
                    total[at] += unpack(more[kind, bucket][model]).astype(np.int64)
                left = total[gram] - count * member[text]
                loss[model] += np.bincount(
                    text, weights=sign * count * np.log(left + pseudo), minlength=grams.texts)
        sizes = np.array(row["sizes"], dtype=np.int64)
        return pa.Table.from_arrays(
            [pa.array(row["docs"], pa.int64()), pa.array(sizes), pa.array(loss["tg"]), pa.array(loss["bg"])],
            schema=LOSS).filter(pa.array(sizes > 0))
    return run


def score_difference(
    docs: DataFrame, target_ids: DataFrame, alpha: float = SMOOTH, shard_words: int = SHARD_WORDS
) -> DataFrame:
    """``(doc_id, n_tokens, target_loss, background_loss, score)`` per id of ``docs``.

    Two matched bigram models are counted over whole texts: the target model
    over the documents in ``target_ids``, the background model over documents
    outside them, drawn by a hash of the id over all of them so that both are
    expected to hold equally many tokens. Where the target holds more tokens
    than the rest, it is the target model that is drawn and the background
    that is whole. A document's own counts are left out of the model it is in.

    Both models are smoothed by ``alpha`` over one vocabulary, the bigram words of all
    documents. The loss of a token is ``ln (c(v) + alpha V) - ln (c(v w) +
    alpha)``, so a document's loss is a sum over its contexts and bigrams, and
    no model is collected or broadcast. Texts are stored as shards of about
    ``shard_words`` word numbers. A shard sends each distinct gram once, as a
    64-bit hash, to the bucket that adds up its counts, and gets back what the
    other shards hold. Shards are dealt out by number and buckets are ranges
    of hashes, as many as there are full shards, so that a task holds about one
    shard or one bucket, however frequent a gram is. ``score`` is the mean of background
    loss less target loss: higher is more like the target.

    A document without tokens, or with a null text, scores 0. Rows that
    repeat an id are scored as one text after another, each less its own
    counts; null ids as one document, outside the target. An empty table gives no rows; without target documents both
    models are empty, hence uniform. Other columns are ignored.
    """
    chosen = target_ids.select("doc_id").filter("doc_id is not null").distinct()
    shards = stored(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
            lambda batches: cut_shards(batches, shard_words),
            "shard long, docs array<long>, sizes array<long>, words binary, ids binary"), "shards")
    listed = shards.select("shard", F.posexplode(F.arrays_zip("docs", "sizes"))).select(
        "shard", "pos", F.col("col.docs").alias("doc_id"), F.col("col.sizes").alias("n"))
    texts = listed.join(chosen.withColumn("t", F.lit(1)), "doc_id", "left").select(
        "shard", "pos", "doc_id", "n", F.coalesce("t", F.lit(0)).alias("target"))
    tokens = texts.agg(F.sum(F.col("n") * F.col("target")), F.sum(F.col("n") * (1 - F.col("target")))).first()
    tokens = [n or 0 for n in tokens]
    buckets = -(-sum(tokens) // shard_words) or 1
    # One word follows another, so the words of the vocabulary are the contexts
    # and each text's last word; the contexts' number stands for it.
    v = (
        shards.select("sizes", "words", "ids").mapInArrow(_contexts(buckets), "bucket long, hashes binary")
        .groupBy("bucket").applyInArrow(_distinct, "n long").agg(F.sum("n")).first()[0] or 1)
    flags = with_shares(texts, *tokens).select(
        F.col("shard").alias("of"), "pos", "in_tg", "in_bg")
    whole = shards.groupBy("shard")
    chunks = whole.cogroup(flags.groupBy("of")).applyInArrow(
        _counted(buckets), "kind int, bucket long, shard long, hashes binary, tg binary, bg binary")
    more = chunks.groupBy("kind", "bucket").applyInArrow(
        _summed, "of long, kind int, bucket long, tg binary, bg binary")
    sums = (
        whole.cogroup(flags.unionByName(more, allowMissingColumns=True).groupBy("of"))
        .applyInArrow(_losses(buckets, alpha, v), "doc_id long, n long, t double, b double")
        .groupBy("doc_id").agg(F.sum("n").alias("n"), F.sum("t").alias("t"), F.sum("b").alias("b")))
    ids = docs.select("doc_id").distinct()
    return ids.join(sums, ids["doc_id"].eqNullSafe(sums["doc_id"]), "left").select(
        ids["doc_id"], F.coalesce("n", F.lit(0)).cast("long").alias("n_tokens"),
        F.coalesce(F.col("t") / F.col("n"), F.lit(0.0)).alias("target_loss"),
        F.coalesce(F.col("b") / F.col("n"), F.lit(0.0)).alias("background_loss"),
        F.coalesce((F.col("b") - F.col("t")) / F.col("n"), F.lit(0.0)).alias("score"))


def drawn(share: float) -> Column:
    """Whether an id is drawn, by its hash: a share of all ids, the same each time."""
    return (F.pmod(F.xxhash64("doc_id", F.lit("drawn")), F.lit(DRAWS)) < int(share * DRAWS)).cast("int")


def with_shares(rows: DataFrame, target: int, rest: int) -> DataFrame:
    """``in_tg`` and ``in_bg``: 1 where the row's document is in that model.
    ``target`` and ``rest`` are the tokens inside and outside the target."""
    least = min(target, rest)
    return rows.withColumn("in_tg", F.col("target") * drawn(least / max(target, 1))).withColumn(
        "in_bg", (1 - F.col("target")) * drawn(least / max(rest, 1)))
