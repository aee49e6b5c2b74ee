"""Quality classifier: histogram gradient-boosted trees over text statistics."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

SAMPLE = 20_000
BINS, TREES, DEPTH, RATE, SMOOTH = 64, 80, 4, 0.15, 5.0
FEATURES = [
    "log_chars", "log_words", "log_lines", "word_length", "letters", "digits", "upper", "spaces",
    "punctuation", "symbols", "non_ascii", "distinct_words", "distinct_lines", "top_word",
    "top_line", "long_words", "line_length", "ended_lines", "distinct_chars", "digit_words",
    "symbol_words", "symbol_runs", "char_entropy", "upper_words",
]
SYMBOLS = re.compile(r"[^\w\s.,;:!?'\"()\-]")
RUNS = re.compile(r"([^\w\s])\1{1,}")


def statistics(text: str | None) -> list[float]:
    """The ``FEATURES`` of one whole text; a null or empty one has zeros."""
    if not text:
        return [0.0] * len(FEATURES)
    n = len(text)
    words, lines = text.split(), [x for x in text.split("\n") if x.strip()]
    nw, nl = max(len(words), 1), max(len(lines), 1)
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    counts = np.bincount(np.minimum(codes, 1024))
    ascii_ = np.zeros(128, dtype=np.int64)
    ascii_[: min(len(counts), 128)] = counts[:128]
    digits, upper = ascii_[48:58].sum(), ascii_[65:91].sum()
    lower, spaces = ascii_[97:123].sum(), ascii_[[9, 10, 13, 32]].sum()
    wide = n - ascii_.sum()
    marks = ascii_[[33, 34, 39, 40, 41, 44, 45, 46, 58, 59, 63]].sum()
    word_set, _, top_word = tally(words)
    line_set, _, top_line = tally(lines)
    share = counts[counts > 0] / n
    odd = sum(1 for w in words if SYMBOLS.search(w))
    return [
        np.log1p(n), np.log1p(len(words)), np.log1p(len(lines)), sum(map(len, words)) / nw,
        (upper + lower + wide) / n, digits / n, upper / n, spaces / n, marks / n,
        (ascii_.sum() - digits - upper - lower - spaces - marks) / n, wide / n,
        word_set / nw, line_set / nl, top_word / nw, top_line / nl,
        sum(1 for w in words if len(w) > 15) / nw, n / nl,
        sum(1 for x in lines if x.rstrip()[-1:] in ".!?\"'") / nl, len(share) / n,
        sum(1 for w in words if any(c.isdigit() for c in w)) / nw, odd / nw,
        len(RUNS.findall(text)) / nw, float(-(share * np.log2(share)).sum()),
        sum(1 for w in words if w.isupper()) / nw,
    ]


def tally(items: list[str]) -> tuple[int, int, int]:
    counts: dict[str, int] = {}
    for item in items:
        counts[item] = counts.get(item, 0) + 1
    return len(counts), len(items), max(counts.values(), default=0)


def with_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """Every row's other columns, with ``features`` in place of the text."""
    kept = [f for f in docs.schema if f.name != text]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)

    def rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = frame[[f.name for f in kept]].copy()
            out["features"] = [np.array(statistics(t), dtype=float) for t in frame[text]]
            yield out

    return docs.mapInPandas(rows, (schema + ", " if schema else "") + "features array<double>")


@dataclass
class Trees:
    """Perfect binary trees, flattened: node ``i`` of a tree has the children
    ``2 i + 1`` (value at most the bound) and ``2 i + 2``."""

    base: float
    feature: np.ndarray  # trees x inner nodes
    bound: np.ndarray
    leaf: np.ndarray  # trees x leaves

    def score(self, x: np.ndarray) -> np.ndarray:
        total, rows = np.full(len(x), self.base), np.arange(len(x))
        for feature, bound, leaf in zip(self.feature, self.bound, self.leaf):
            at = np.zeros(len(x), dtype=np.int64)
            for _ in range(DEPTH):
                at = 2 * at + 1 + (x[rows, feature[at]] > bound[at])
            total += leaf[at - (2**DEPTH - 1)]
        return 1 / (1 + np.exp(-total))


def fit_trees(x: np.ndarray, y: np.ndarray) -> Trees:
    """Boosting with logistic loss; splits are found on histograms of gradients."""
    rate = (y.sum() + 1.0) / (len(y) + 2.0) if len(y) else 0.5
    base = float(np.log(rate / (1 - rate)))
    inner, leaves = 2**DEPTH - 1, 2**DEPTH
    feature = np.zeros((TREES, inner), dtype=np.int64)
    bound = np.full((TREES, inner), np.inf)
    leaf = np.zeros((TREES, leaves))
    if not len(y) or y.min() == y.max():
        return Trees(base, feature[:0], bound[:0], leaf[:0])
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
    binned = np.stack([np.searchsorted(c, v, side="left") for c, v in zip(cuts, x.T)], axis=1)
    raw = np.full(len(y), base)
    for t in range(TREES):
        p = 1 / (1 + np.exp(-raw))
        g, h = y - p, p * (1 - p)
        at = np.zeros(len(y), dtype=np.int64)
        for depth in range(DEPTH):
            first, width = 2**depth - 1, 2**depth
            local, best = at - first, np.full(width, 1e-6)
            for f, cut in enumerate(cuts):
                key = local * BINS + binned[:, f]
                gl = np.bincount(key, g, width * BINS).reshape(width, BINS).cumsum(1)
                hl = np.bincount(key, h, width * BINS).reshape(width, BINS).cumsum(1)
                gt, ht = gl[:, -1:], hl[:, -1:]
                gain = (gl**2 / (hl + SMOOTH) + (gt - gl) ** 2 / (ht - hl + SMOOTH)
                        - gt**2 / (ht + SMOOTH))[:, : len(cut)]
                if not gain.shape[1]:
                    continue
                pick = gain.argmax(1)
                value = gain[np.arange(width), pick]
                better = value > best
                best[better] = value[better]
                feature[t, first : first + width][better] = f
                bound[t, first : first + width][better] = cut[pick[better]]
            at = 2 * at + 1 + (x[np.arange(len(y)), feature[t][at]] > bound[t][at])
        at -= inner
        leaf[t] = RATE * np.bincount(at, g, leaves) / (np.bincount(at, h, leaves) + SMOOTH)
        raw += leaf[t][at]
    return Trees(base, feature, bound, leaf)


def held_out(doc_id="doc_id"):
    return F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(3)) == 1


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Trees:
    """Trees fitted on at most ``sample`` labelled documents (the smallest
    hashes of their ids), none of them held out. Only their statistics come
    to the driver. Null labels teach nothing; repeated labels count by their
    mean, repeated documents by their mean statistics."""
    chosen = (
        labels.filter("doc_id is not null and quality is not null").filter(~held_out())
        .groupBy("doc_id").agg(F.avg("quality").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    )
    known = with_statistics(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id"))
    rows = known.groupBy("doc_id").agg(F.first("quality").alias("quality"), *[
        F.avg(F.get("features", F.lit(i))).alias(f"f{i}") for i in range(len(FEATURES))]).toPandas()
    rows = rows.sort_values("doc_id")
    x = rows[[f"f{i}" for i in range(len(FEATURES))]].to_numpy(dtype=float)
    return fit_trees(x, (rows["quality"].to_numpy(dtype=float) >= 0.5).astype(float))


def score_quality(docs: DataFrame, trees: Trees, text: str = "text") -> DataFrame:
    """Every row with ``score`` (how likely label 1 is) and ``predicted``.

    Scores come from whole texts alone; null and empty texts score as texts
    with all statistics zero. Without any label all rows score 0.5.
    """
    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        x = np.array([statistics(t) for t in texts], dtype=float).reshape(len(texts), len(FEATURES))
        return pd.Series(trees.score(x))

    kept = [c for c in docs.columns if c not in ("score", "predicted")]
    return docs.select(*kept, score(text).alias("score")).withColumn(
        "predicted", (F.col("score") >= 0.5).cast("int"))
