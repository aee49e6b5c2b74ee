"""Phrase collocations by FM-indexes over word ids, one per shard of the texts."""

from __future__ import annotations

import itertools
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from scriptorium.llm.common import stored
from scriptorium.llm.hashed import bucketed, pack, pair_hashes, unpack, word_hashes

DEPTH, LEAST, TOP, SHARD_WORDS, PAIR_BITS = 5, 100, 2000, 1 << 21, 40
# Lower case for A-Z, a line feed for what ends a piece, a space for a tab.
_FOLD = bytes(
    10 if c in b".,;:!?\n\x0b\x0c\r" else 32 if c == 9 else c + 32 if 65 <= c <= 90 else c
    for c in range(256)
)
SHARD_SCHEMA = pa.schema([
    ("shard", pa.int64()), ("lang", pa.string()), ("words", pa.list_(pa.string())),
    ("counts", pa.list_(pa.int64())), ("ids", pa.binary()),
])


def pack_ids(ids: np.ndarray) -> bytes:
    """Word ids as compressed bytes: all lowest bytes first, then the next,
    of which most are 0."""
    planes = ids.astype("<i4").view(np.uint8).reshape(-1, 4).T
    return zstandard.compress(planes.tobytes())


def unpack_ids(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(packed), dtype=np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<i4").ravel().astype(np.int64)


class Shard:
    """Word ids of the texts of one language; -1 stands between pieces."""

    def __init__(self) -> None:
        self.words: dict[bytes, int] = {b"": -2, b"\n": -1}
        self.parts: list[np.ndarray] = []
        self.size = 0

    def add(self, text: bytes) -> None:
        known = self.words
        tokens = text.translate(_FOLD).replace(b"\n", b" \n ").split(b" ")
        for token in set(tokens).difference(known):
            known[token] = len(known) - 2
        ids = np.fromiter(map(known.__getitem__, tokens), dtype=np.int32, count=len(tokens))
        ids = ids[ids > -2]
        self.parts += [ids, np.array([-1], dtype=np.int32)]
        self.size += len(ids) + 1

    def row(self, number: int, lang: str) -> dict:
        ids = np.concatenate(self.parts)
        words = [w.decode() for w in self.words][2:]
        return {"shard": number, "lang": lang, "words": words, "ids": pack_ids(ids),
                "counts": np.bincount(ids[ids >= 0], minlength=len(words)).tolist()}


def cut_shards(batches: Iterable[pa.RecordBatch], limit: int = SHARD_WORDS) -> Iterator[pa.RecordBatch]:
    """Texts to shards of about ``limit`` words. A task holds at most twice as
    many: beyond that its largest shard is written. Shards are numbered by
    task and order, the same in a repeated task."""
    open_: dict[str, Shard] = {}
    context = TaskContext.get()
    numbers = itertools.count((context.partitionId() if context else 0) << 32)

    def written(lang: str) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist(
            [open_.pop(lang).row(next(numbers), lang)], schema=SHARD_SCHEMA)

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            shard = open_.setdefault(lang, Shard())
            shard.add(text)
            if shard.size >= limit:
                yield written(lang)
            elif sum(s.size for s in open_.values()) >= 2 * limit:
                yield written(max(open_, key=lambda name: open_[name].size))
    for lang in list(open_):
        yield written(lang)


def _suffix_order(ids: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes in the order of their first ``depth`` symbols, ties in any.
    Ranks of twice as many symbols come from pairs of ranks."""
    rank, have, n = ids.astype(np.int64), 1, len(ids)
    while have < depth:
        step = min(have, depth - have)
        after = np.zeros(n, dtype=np.int64)
        after[: n - step] = rank[step:]
        key = rank * (int(rank.max()) + 1) + after
        order = np.argsort(key)
        have += step
        if have < depth:
            changed = np.diff(key[order], prepend=-1) != 0
            rank = np.empty(n, dtype=np.int64)
            rank[order] = np.cumsum(changed)
    return order


class HalfIndex:
    """BWT of one reading direction with ranks of symbols in it."""

    def __init__(self, ids: np.ndarray, depth: int):
        self.n = len(ids)
        order = _suffix_order(ids, depth)
        self.bwt = ids[order - 1].astype(np.int64)  # the text is read as a ring; it begins with 0
        self.first = np.searchsorted(np.sort(ids), np.arange(int(ids.max()) + 2))
        self.places = np.sort(self.bwt * self.n + np.arange(self.n))
        turns = np.flatnonzero(np.diff(self.bwt)) + 1
        self.run_end = np.append(turns, self.n)[
            np.searchsorted(turns, np.arange(self.n), side="right")]

    def before(self, symbol: np.ndarray, row: np.ndarray) -> np.ndarray:
        """First suffix row of ``symbol`` followed by what stands above ``row``:
        the LF mapping, its rank read from the sorted places of the symbol."""
        return np.searchsorted(self.places, symbol * self.n + row)

    def sole(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The symbol before all rows of an interval, 0 where it varies or the
        piece begins there."""
        return np.where(self.run_end[low] >= high, self.bwt[low], 0)


class FmIndex:
    """Bidirectional index, exact for grams of up to ``depth`` symbols. Symbol
    0 separates pieces. A gram is an interval of suffixes (``low``, ``high``)
    and one of the reversed text's suffixes from ``back`` on."""

    def __init__(self, ids: np.ndarray, depth: int):
        self.ahead, self.behind = HalfIndex(ids, depth), HalfIndex(ids[::-1].copy(), depth)

    def symbols(self) -> tuple[np.ndarray, ...]:
        """Grams of one symbol: symbol, low, high, back."""
        first = self.ahead.first
        symbol = np.flatnonzero(np.diff(first, append=self.ahead.n)) if len(first) else first
        symbol = symbol[symbol > 0]
        ends = np.append(first, self.ahead.n)[symbol + 1]
        return symbol, first[symbol], ends, first[symbol]

    def extend_right(self, low, high, back):
        """All grams one symbol longer: parent, symbol, low, high, back. The
        reversed text's interval gives the symbols that follow and how often;
        those smaller ones before it move the suffix interval along."""
        size = high - low
        total = int(size.sum())
        parent = np.repeat(np.arange(len(low)), size)
        rows = np.arange(total) - np.repeat(np.cumsum(size) - size, size) + np.repeat(back, size)
        alphabet = len(self.behind.first)
        key, count = np.unique(parent * alphabet + self.behind.bwt[rows], return_counts=True)
        parent, symbol = key // alphabet, key % alphabet
        smaller = np.cumsum(count) - count
        opens = np.searchsorted(parent, np.arange(len(low)))
        start = low[parent] + smaller - smaller[opens[parent]]
        to = self.behind.before(symbol, back[parent])
        keep = symbol > 0
        return tuple(x[keep] for x in (parent, symbol, start, start + count, to))

    def grams(self, depth: int) -> Iterator[tuple[np.ndarray, ...]]:
        """Per length from 2: words (rows of symbols), count, the sole symbol
        to the left of all occurrences, and to the right."""
        symbol, low, high, back = self.symbols()
        words = symbol[:, None]
        for _ in range(2, depth + 1):
            parent, symbol, low, high, back = self.extend_right(low, high, back)
            if not len(parent):
                return
            words = np.column_stack([words[parent], symbol])
            count = high - low
            yield (words, count, self.ahead.sole(low, high), self.behind.sole(back, back + count))


def chains(ids: np.ndarray, linked: np.ndarray) -> np.ndarray:
    """Symbols from 1 (0 between pieces, first and last): only runs of two or
    more words of which each neighbouring pair is linked."""
    joint = np.flatnonzero(linked)
    if not len(joint):
        return np.zeros(0, dtype=np.int64)
    opens = np.diff(joint, prepend=-2) != 1
    # Each run gives its words and one separator before them.
    place = np.arange(len(joint)) + 2 * np.cumsum(opens)
    out = np.zeros(place[-1] + 2, dtype=np.int64)
    out[place - 1] = ids[joint] + 1
    out[place] = ids[joint + 1] + 1
    return out


def _compact(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbols renumbered without gaps, 0 kept, and the old number of each."""
    old = np.unique(symbols)
    return np.searchsorted(old, symbols), old


CHUNK = pa.schema([
    ("lang", pa.string()), ("bucket", pa.int64()), ("shard", pa.int64()), ("hashes", pa.binary()),
    ("counts", pa.binary())])
HITS = pa.schema([("of", pa.int64()), ("bucket", pa.int64()), ("linked", pa.binary())])
FOUND = pa.schema([
    ("lang", pa.string()), ("bucket", pa.int64()), ("phrases", pa.binary()), ("counts", pa.binary()),
    ("left", pa.binary()), ("right", pa.binary())])
GRAMS = pa.schema([
    ("lang", pa.string()), ("phrase", pa.string()), ("size", pa.int32()), ("f", pa.int64()), ("covered", pa.bool_())])


def _pack_lines(lines: Iterable[str]) -> bytes:
    """Words and phrases hold no line break."""
    return zstandard.compress("\n".join(lines).encode())


def _unpack_lines(packed: bytes) -> list[str]:
    return zstandard.decompress(packed).decode().split("\n")


def _linked(ids: np.ndarray, frequent: np.ndarray, words: int) -> np.ndarray:
    """Where two neighbours are frequent words."""
    known = np.zeros(words + 1, bool)  # the last for -1, what ends a piece
    known[frequent] = True
    return known[ids[:-1]] & known[ids[1:]]


def _pair_hashes(words: list[str], first: np.ndarray, second: np.ndarray, bits: int) -> np.ndarray:
    used = np.unique(np.concatenate([first, second]))
    own = np.zeros(len(words), dtype=np.uint64)
    own[used] = word_hashes(words[i] for i in used.tolist())
    return pair_hashes(own[first], own[second]) >> np.uint64(64 - bits)


def _pairs(buckets: int, bits: int):
    def run(shard: pa.Table, frequent: pa.Table) -> pa.Table:
        """Counts of neighbouring frequent words of a shard, by bucket of their hash."""
        row = shard.to_pylist()[0]
        ids, out = unpack_ids(row["ids"]), []
        symbols, old = _compact(chains(ids, _linked(ids, frequent["id"].to_numpy(), len(row["words"]))))
        for words, count, _, _ in FmIndex(symbols, 2).grams(2) if len(symbols) else ():
            hashes = _pair_hashes(row["words"], *(old[words] - 1).T, bits)
            out += [
                {"lang": row["lang"], "bucket": bucket, "shard": row["shard"], "hashes": packed,
                 "counts": pack(count[at])}
                for bucket, at, packed in bucketed(hashes, buckets, bits)]
        return pa.Table.from_pylist(out, schema=CHUNK)
    return run


def _often(least: int):
    def run(chunks: pa.Table) -> pa.Table:
        """Which pairs of each shard's chunk of a bucket occur ``least`` times over all shards."""
        hashes = [np.cumsum(unpack(x.as_py())) for x in chunks["hashes"]]
        _, pair = np.unique(np.concatenate(hashes), return_inverse=True)
        counts = np.concatenate([unpack(x.as_py()) for x in chunks["counts"]])
        often = (np.bincount(pair, weights=counts) >= least)[pair]
        masks = np.split(often, np.cumsum([len(x) for x in hashes])[:-1])
        return pa.Table.from_pylist([
            {"of": shard, "bucket": bucket, "linked": zstandard.compress(np.packbits(mask).tobytes())}
            for shard, bucket, mask in zip(chunks["shard"].to_pylist(), chunks["bucket"].to_pylist(), masks)
            if mask.any()], schema=HITS)
    return run


def _grams(buckets: int, depth: int, bits: int):
    def run(shard: pa.Table, right: pa.Table) -> pa.Table:
        """Counts and sole neighbours of the grams of linked words of a shard,
        by bucket of a hash of their words, in which they stand sorted."""
        row = shard.to_pylist()[0]
        ids, width = unpack_ids(row["ids"]), len(row["words"]) + 1
        linked = _linked(ids, right["id"].drop_null().to_numpy(), len(row["words"]))
        hits = right.filter(right["bucket"].is_valid()).to_pylist()
        masks = {x["bucket"]: np.frombuffer(zstandard.decompress(x["linked"]), np.uint8) for x in hits}
        pairs, place = np.unique((ids[:-1] * width + ids[1:])[linked], return_inverse=True)
        often = np.zeros(len(pairs), bool)
        if masks:
            hashes = _pair_hashes(row["words"], *np.divmod(pairs, width), bits)
            for bucket, at, _ in bucketed(hashes, buckets, bits):
                if bucket in masks:
                    often[at] = np.unpackbits(masks[bucket], count=len(at)).astype(bool)
        linked[linked] = often[place]
        symbols, old = _compact(chains(ids, linked))
        names, out = np.array([""] + row["words"], dtype=object)[old], []
        own = word_hashes(names)
        for words, count, left, right in FmIndex(symbols, depth).grams(depth) if len(symbols) else ():
            key = own[words[:, 0]]
            for at in range(1, words.shape[1]):
                key = pair_hashes(key, own[words[:, at]])
            for bucket, at, _ in bucketed(key, buckets):
                made = sorted((" ".join(x), i) for x, i in zip(names[words[at]], at.tolist()))
                at = np.array([i for _, i in made])
                out.append({
                    "lang": row["lang"], "bucket": bucket, "phrases": _pack_lines(x for x, _ in made),
                    "counts": pack(count[at]), "left": _pack_lines(names[left[at]]),
                    "right": _pack_lines(names[right[at]])})
        return pa.Table.from_pylist(out, schema=FOUND)
    return run


def _frequent_grams(least: int):
    def run(chunks: pa.Table) -> pa.Table:
        """The phrases of a bucket that occur ``least`` times over all shards."""
        def lines(column: str) -> np.ndarray:
            parts = [_unpack_lines(x.as_py()) for x in chunks[column]]
            return pd.factorize(np.array(list(itertools.chain.from_iterable(parts)), dtype=object))

        gram, phrases = lines("phrases")
        count = np.bincount(gram, weights=np.concatenate([unpack(x.as_py()) for x in chunks["counts"]]))
        order = np.argsort(gram, kind="stable")
        first = np.searchsorted(gram[order], np.arange(len(phrases)))
        covered = np.zeros(len(phrases), bool)
        for column in ("left", "right"):
            # Whether all shards name the same one neighbour.
            word, words = lines(column)
            word = word[order]
            covered |= (np.minimum.reduceat(word, first) == np.maximum.reduceat(word, first)) & (
                words[word[first]] != "")
        kept = np.flatnonzero(count >= least)
        return pa.table([
            pa.array([chunks["lang"][0].as_py()] * len(kept), pa.string()), pa.array(phrases[kept], pa.string()),
            pa.array([x.count(" ") + 1 for x in phrases[kept]], pa.int32()),
            pa.array(count[kept].astype(np.int64)), pa.array(covered[kept])], schema=GRAMS)
    return run


def phrase_counts(
    docs: DataFrame, least: int = LEAST, depth: int = DEPTH, shard_words: int = SHARD_WORDS,
    pair_bits: int = PAIR_BITS,
):
    """``(words, grams)``: the words (lang, phrase, f) and the phrases of 2 to
    ``depth`` words (also ``size`` and ``covered``) that occur at least
    ``least`` times in a language; words holds rarer ones too. ``covered``:
    every occurrence has one and the same word to its left, or to its right.

    Texts are dealt into shards. What a shard may leave out is decided on sums
    over all shards: a frequent phrase holds only frequent words and frequent
    neighbouring pairs, so two rounds tell each shard which of its own those
    are, and it cuts its text at all others. Pairs are summed up as hashes of
    ``pair_bits`` bits, in buckets that are ranges of them: two pairs of one
    hash can only let a rarer pair pass, as phrases are counted by their words.
    Phrases, too, are sent as sorted lists of one bucket and shard.
    """
    spark = docs.sparkSession
    texts = docs.filter("text is not null").select(
        F.coalesce("lang", F.lit("und")).alias("lang"), F.col("text").cast("binary").alias("text"))
    shards = stored(
        texts.mapInArrow(
            lambda batches: cut_shards(batches, shard_words),
            "shard long, lang string, words array<string>, counts array<long>, ids binary"), "shards")
    listed = shards.select("shard", "lang", F.posexplode(F.arrays_zip("words", "counts")))
    local = listed.select(
        "shard", "lang", F.col("pos").alias("id"), F.col("col.words").alias("phrase"),
        F.col("col.counts").alias("n"))
    words = stored(local.groupBy("lang", "phrase").agg(F.sum("n").alias("f")), "words")
    total = words.agg(F.sum("f")).first()[0] or 0
    buckets = -(-total // shard_words) or 1
    # A word has one row per shard at most; they meet once.
    whole = F.sum("n").over(Window.partitionBy("lang", "phrase"))
    frequent = stored(
        local.withColumn("f", whole).filter(F.col("f") >= least)
        .select(F.col("shard").alias("of"), "id"), "frequent")
    dealt = shards.select("shard", "lang", "words", "ids").groupBy("shard")
    hits = (
        dealt.cogroup(frequent.groupBy("of")).applyInArrow(
            _pairs(buckets, pair_bits), "lang string, bucket long, shard long, hashes binary, counts binary")
        .groupBy("lang", "bucket").applyInArrow(_often(least), "of long, bucket long, linked binary"))
    found = dealt.cogroup(frequent.unionByName(hits, allowMissingColumns=True).groupBy("of")).applyInArrow(
        _grams(buckets, depth, pair_bits),
        "lang string, bucket long, phrases binary, counts binary, left binary, right binary")
    grams = stored(
        found.groupBy("lang", "bucket").applyInArrow(
            _frequent_grams(least), "lang string, phrase string, size int, f long, covered boolean"), "grams")
    return words, grams


def collocations(
    docs: DataFrame, least: int = LEAST, depth: int = DEPTH, top: int = TOP,
    shard_words: int = SHARD_WORDS, pair_bits: int = PAIR_BITS,
) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: per language the phrases of
    2 to ``depth`` words with the highest association at their weakest cut.

    A phrase is left out if one word more, to one fixed side, occurs with every
    occurrence of it (and is still within ``depth`` words): any longer phrase
    as frequent holds such a one. Null and empty texts hold no words; a null
    lang is ``und``; repeated rows count each; tables without words give no
    rows; columns other than ``text`` and ``lang`` are not looked at.
    """
    words, grams = phrase_counts(docs, least, depth, shard_words, pair_bits)
    total = words.groupBy("lang").agg(F.sum("f").alias("n"))
    parts = words.filter(F.col("f") >= least).unionByName(grams.select("lang", "phrase", "f"))
    kept = grams.filter((F.col("size") == depth) | ~F.col("covered"))
    split = F.split("phrase", " ")
    cuts = kept.select(
        "lang", "phrase", F.col("f").alias("a"), split.alias("split"), "size",
        F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = cuts.select(
        "lang", "phrase", "a", "k",
        F.array_join(F.slice("split", F.lit(1), F.col("k")), " ").alias("head"),
        F.array_join(F.slice("split", F.col("k") + 1, F.col("size") - F.col("k")), " ").alias("tail"))
    head = parts.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l"))
    tail = parts.select("lang", F.col("phrase").alias("tail"), F.col("f").alias("r"))
    score = F.expr(
        "cast((1000BD * cast(a as decimal(16, 0)) * cast(n as decimal(16, 0)))"
        " div (cast(l as decimal(19, 0)) * cast(r as decimal(19, 0))) as long)")
    scored = (
        cuts.join(head, ["lang", "head"]).join(tail, ["lang", "tail"]).join(F.broadcast(total), "lang")
        .withColumn("score", score)
        .groupBy("lang", "phrase").agg(
            F.min(F.struct("score", "k", "a", "l", "r", "n")).alias("cut"))
        .select("lang", "phrase", "cut.a", "cut.l", "cut.r", "cut.n", "cut.score"))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # The first rows of each part of a language, then of the language.
    dealt = scored.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(64)))
    first = dealt.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order)))
    first = first.filter(F.col("rank") <= top).drop("rank", "part")
    ranked = first.withColumn(
        "rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return ranked.filter(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
