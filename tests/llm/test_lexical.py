"""Ranked lexical search against scoring every document by hand."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from scriptorium.llm import lexical


def words(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", low)


def brute(docs, items, top=10):
    spelled = [(i, words(t)) for i, t in docs]
    n_docs, n_terms = sum(bool(w) for _, w in spelled), sum(len(w) for _, w in spelled)
    df = Counter(t for _, w in spelled for t in set(w))
    asked = {}
    for i, t in items:
        if i is not None:
            asked.setdefault(i, []).extend(words(t))
    out = []
    for item, terms in asked.items():
        found = []
        for doc, own in spelled:
            tf = Counter(own)
            m = n_terms and 100 - 75 + (75 * len(own) * n_docs) // n_terms
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                * ((1000000000 * tf[t]) // (1000 * tf[t] + 8 * m)) for t in terms if tf[t])
            if score > 0 and doc is not None:
                found.append((-score, doc))
        out += [(item, r + 1, d, -s) for r, (s, d) in enumerate(sorted(found)[:top])]
    return sorted(out)


def texts(seed=1, count=400):
    dice = random.Random(seed)
    common = ["the", "of", "And", "x1", "élan", "日本"]
    rows = []
    for i in range(count):
        size = dice.choice([1, 5, 30, 200, 900])
        rows.append((i, " ".join(
            dice.choice(common) if dice.random() < 0.5 else f"w{int(dice.paretovariate(0.6)) % 5000}-"
            for _ in range(size))))
    return rows + [(900, None), (901, ""), (902, " .,-"), (903, rows[3][1]), (903, rows[3][1]), (2, "the oak"),
                   (None, "the lone oak"), (904, "the " * 70_000 + "oak")]


def asked(docs):
    picked = [docs[i][1] for i in range(0, 300, 7)]
    return [(i, " ".join(words(t)[:40])) for i, t in enumerate(picked)] + [
        (100, None), (101, "?"), (102, "nowhereword"), (103, "the THE the oak"), (None, "the oak"), (104, "oak"), (104, "lone oak")]


@pytest.mark.parametrize("small", [False, True])
def test_ranking_equals_scoring_all(spark, monkeypatch, small):
    if small:  # several groups of items, many blocks of documents
        monkeypatch.setattr(lexical, "ROWS", 16)
        monkeypatch.setattr(lexical, "ITEM_BYTES", 30_000)
    docs = texts()
    items = asked(docs)
    table = spark.createDataFrame(
        [(i, t, 1, "x", 5) for i, t in docs], "doc_id long, text string, item_id int, terms string, bits int").repartition(3)
    asked_table = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, floor int")
    got = lexical.search(table, asked_table).collect()
    assert sorted(tuple(r) for r in got) == brute(docs, items)
    if not small:
        for d, i in ((table.limit(0), asked_table), (table, asked_table.limit(0)), (table.filter("text = ''"), asked_table)):
            assert lexical.search(d, i).count() == 0


def test_bounds_are_never_below_scores_and_exclude_documents():
    import pyarrow as pa

    docs = [(i, t.encode().lower()) for i, t in texts(7, 200) if t]
    batch = pa.RecordBatch.from_arrays(
        [pa.array([i or -1 for i, _ in docs], pa.int64()), pa.array([t for _, t in docs], pa.binary())], names=["i", "t"])
    blocks = [r for b in lexical.build_blocks([batch]) for r in b.to_pylist()]
    spelled = {i or -1: Counter(lexical._WORD.findall(t)) for i, t in docs}
    n_docs, n_terms = sum(len(b["ids"]) for b in blocks), sum(sum(b["lengths"]) for b in blocks)
    assert n_docs == sum(bool(lexical._WORD.findall(t)) for _, t in docs)
    terms = [(t, 10 + i) for i, t in enumerate(sorted(set().union(*spelled.values()))[::9])]
    block = lexical.ItemBlock({1: terms, 2: terms[:3]})
    below = 0
    for b in blocks:
        lengths, most = np.array(b["lengths"]), np.array(b["most"])
        bounds = block.bounds(lengths, most, b["bits"], b["slices"], n_docs, n_terms)
        for j, doc in enumerate(b["ids"]):
            if lengths[j] != spelled[doc].total():
                continue  # the other row of a repeated id
            damper = 8 * (25 + (75 * int(lengths[j]) * n_docs) // n_terms)
            for i, some in enumerate((terms, terms[:3])):
                exact = sum(w * ((10**9 * n) // (1000 * n + damper)) for t, w in some if (n := spelled[doc][t]))
                assert bounds[i, j] >= exact
                below += bounds[i, j] == 0
    assert below > 20
