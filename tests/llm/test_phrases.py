"""Phrase collocations against counting by hand."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa

from scriptorium.llm import phrases
from scriptorium.llm.phrases import FmIndex


def brute(rows, least, depth, top):
    """The definition, word by word."""
    out = []
    grams, total = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            words = [w for w in re.split("[ \t]+", piece) if w]
            total[lang] += len(words)
            for size in range(1, depth + 1):
                for i in range(len(words) - size + 1):
                    grams[lang][tuple(words[i : i + size])] += 1
    for lang, f in grams.items():
        found = {g for g, a in f.items() if len(g) > 1 and a >= least}

        def inside(g):
            return any(
                len(h) > len(g) and f[h] >= f[g]
                and any(h[i : i + len(g)] == g for i in range(len(h) - len(g) + 1)) for h in found)

        rows_ = []
        for g in found:
            if inside(g):
                continue
            score, k = min(
                (1000 * f[g] * total[lang] // (f[g[:k]] * f[g[k:]]), k) for k in range(1, len(g)))
            rows_.append((-score, -f[g], " ".join(g).encode(), f[g[:k]], f[g[k:]]))
        rows_.sort()
        out += [
            (lang, i + 1, p.decode(), -a, l, r, total[lang], -s)
            for i, (s, a, p, l, r) in enumerate(rows_[:top])]
    return sorted(out)


def texts(seed=3):
    dice = random.Random(seed)
    words = ["the", "The", "of", "oak", "élan", "a", "b", "c", "new", "york", "x1"]
    rows = []
    for i in range(120):
        made = []
        for _ in range(dice.randrange(60)):
            made += dice.choice([["new", "york"], ["a", "a", "a"], [dice.choice(words)], ["once", "upon", "a", "b", "c", "time"]])
        rows.append(("".join(w + dice.choice([" ", " ", "  ", "\t", ". ", "\n", ", "]) for w in made), dice.choice(["en", "en", "de", None])))
    return rows + [(None, "en"), ("", "en"), (" \t.", "fr"), (rows[0][0], rows[0][1])]


def test_collocations_equal_counting(spark):
    rows = texts()
    docs = spark.createDataFrame(
        [(t, l, 1, 2, "n") for t, l in rows], "text string, lang string, shard int, a int, phrase string"
    ).repartition(3)
    for least, depth, top, size in ((4, 5, 2000, 1 << 21), (2, 5, 2000, 50), (3, 3, 5, 200)):
        got = phrases.collocations(docs, least, depth, top, size).collect()
        assert sorted(tuple(r) for r in got) == brute(rows, least, depth, top)
    assert phrases.collocations(docs.limit(0)).count() == 0
    assert phrases.collocations(docs.filter("text = ''")).count() == 0
    assert phrases.collocations(docs).count() == len(brute(rows, 100, 5, 2000))


def test_index_intervals_are_the_occurrences():
    dice = np.random.default_rng(1)
    body = dice.integers(0, 5, 300)
    ids = np.concatenate([[0], body, [0]])
    seen = Counter()
    for size in range(2, 6):
        for i in range(len(ids) - size + 1):
            gram = tuple(int(x) for x in ids[i : i + size])
            if 0 not in gram:
                seen[gram] += 1
    found, left_sole, right_sole = Counter(), {}, {}
    for words, count, left, right in FmIndex(ids, 5).grams(5):
        for w, n, a, b in zip(words.tolist(), count.tolist(), left.tolist(), right.tolist()):
            found[tuple(w)] += n
            left_sole[tuple(w)], right_sole[tuple(w)] = a, b
    assert found == seen
    for gram in seen:
        at = [i for i in range(len(ids)) if tuple(ids[i : i + len(gram)]) == gram]
        before, after = {int(ids[i - 1]) for i in at}, {int(ids[i + len(gram)]) for i in at}
        assert left_sole[gram] == (before.pop() if len(before) == 1 else 0)
        assert right_sole[gram] == (after.pop() if len(after) == 1 else 0)


def test_long_text_and_long_piece(spark):
    long = " ".join(["alpha beta"] * 40_000)
    docs = spark.createDataFrame([(long, "en")], "text string, lang string")
    got = phrases.collocations(docs, shard_words=1000).collect()
    assert sorted(tuple(r) for r in got) == brute([(long, "en")], 100, 5, 2000)


def test_pairs_of_one_hash_change_nothing(spark):
    """A hash of few bits lets rare pairs pass; phrases are counted by words."""
    rows = texts(5)
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(2)
    got = phrases.collocations(docs, 4, 5, 2000, 500, 3).collect()
    assert sorted(tuple(r) for r in got) == brute(rows, 4, 5, 2000)


def test_pairs_are_sent_packed():
    """Pairs leave a shard as a few packed rows."""
    shard, = (r for b in phrases.cut_shards([pa.record_batch({
        "lang": ["en"], "text": [" ".join(f"w{i * i % 997}" for i in range(20_000)).encode()]})])
        for r in [b.slice(0, 1)])
    table = pa.Table.from_batches([shard])
    frequent = pa.table({"id": range(len(shard["words"].to_pylist()[0]))})
    chunks = phrases._pairs(4, 40)(table, frequent)
    pairs = sum(len(phrases.unpack(x.as_py())) for x in chunks["hashes"])
    assert chunks.num_rows == 4 and pairs > 900
    assert sum(len(x.as_py()) for x in chunks["hashes"]) < 6 * pairs
