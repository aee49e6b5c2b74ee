"""The ten operators and the pipeline against brute force and odd rows."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
import public_tokenizers
from scriptorium.llm import (
    chat_format, decontaminate, licenses, lm_score, minhash, packing, quality, secrets, url_filter,
    vectors,
)

WORDS = [f"w{i}" for i in range(400)]
LONG = " ".join(WORDS)
ROWS = [
    (1, LONG), (2, LONG), (3, LONG.replace("w17 ", "x ")), (4, None), (5, ""), (6, ""),
    (7, " ".join(reversed(WORDS))), (8, "two words"), (8, "two words"), (None, "no id"),
]


@pytest.fixture
def docs(spark):
    rows = [(i, t, "x", 1, 2, 3) for i, t in ROWS]
    return spark.createDataFrame(
        rows, "doc_id long, text string, key string, size int, node int, score int")


def test_minhash(docs):
    got = Counter((r.doc_id, r.class_id) for r in minhash.near_duplicates(docs).collect())
    assert got == Counter([(1, 1), (2, 1), (3, 1), (4, 4), (5, 5), (6, 5), (7, 7), (8, 8), (8, 8), (None, None)])
    kept = sorted(r.doc_id or 0 for r in minhash.keep_one(docs).collect())
    assert kept == [0, 1, 4, 5, 7, 8]
    assert minhash.near_duplicates(docs.limit(0)).count() == 0


def brute_classes(rows):
    """Class per row of ``(doc_id, text)``: every pair of multisets compared."""
    bags = []
    for _, text in rows:
        words = re.findall(r"[^\W_]+", text.lower())
        bags.append(Counter(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))) if words else Counter([text]))
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sum((bags[i] & bags[j]).values()) >= 0.8 * sum((bags[i] | bags[j]).values()) - 1e-12:
                root[top(i)] = top(j)
    return [min(rows[j][0] for j in range(len(rows)) if top(j) == top(i)) for i in range(len(rows))]


def varied_rows(seed):
    """Texts with repeats, exact copies, near copies, chains, and shared ids."""
    rng, rows = np.random.default_rng(seed), []
    for family in range(12):
        words = [f"t{family}x{w}" for w in rng.integers(0, 60, 80)]
        for copy in range(int(rng.integers(1, 7))):
            rows.append((len(rows), " ".join(words)))
            if rng.random() < 0.7:
                words[int(rng.integers(0, 80))] = f"new{len(rows)}"
    rows += [(3, "a text of its own under a used id"), (5, rows[0][1]), (5, rows[0][1]), (90, "..."), (91, "..."), (92, "")]
    return rows


def test_minhash_equals_all_pairs(spark):
    rows = varied_rows(3)
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    want = Counter((i, c) for (i, _), c in zip(rows, brute_classes(rows)))
    assert Counter(tuple(r) for r in minhash.near_duplicates(frame).collect()) == want


def test_keep_one_keeps_a_row_of_every_class(spark):
    """Classes are of texts: an id that two texts share loses neither."""
    rows = [(1, LONG), (5, LONG), (5, "a text that only this row has"), (7, "one"), (7, "two"), (9, LONG),
            (9, None), (9, None), (None, LONG), (8, "same"), (8, "same")]
    frame = spark.createDataFrame([(i, t, n, "x") for n, (i, t) in enumerate(rows)],
                                  "doc_id long, text string, node int, lead string")
    kept = minhash.keep_one(frame)
    assert kept.columns == frame.columns
    got = Counter((r.doc_id, r.text) for r in kept.collect())
    assert got == Counter([(1, LONG), (5, rows[2][1]), (7, "one"), (7, "two"), (9, None), (9, None),
                           (None, LONG), (8, "same")])
    assert minhash.keep_one(frame.limit(0)).count() == 0
    varied = varied_rows(4)
    distinct = [(n, t) for n, (_, t) in enumerate(varied)]
    classes = brute_classes(distinct)
    frame = spark.createDataFrame(distinct, "doc_id long, text string")
    assert sorted(r.doc_id for r in minhash.keep_one(frame).collect()) == sorted(set(classes))


def test_bag_signatures_estimate_weighted_jaccard():
    a = {i: 1 + i % 5 for i in range(200)}
    b = {i: 1 + (i * 3) % 4 for i in range(100, 300)}
    entries = [(d, i, w) for d, bag in enumerate((a, b)) for i, w in bag.items()]
    doc, element, weight = (np.array(c, dtype=np.int64) for c in zip(*entries))
    sign = minhash.bag_signatures(doc, minhash.mix(element.astype(np.uint64)), weight, 2, 4096)
    keys = a.keys() | b.keys()
    exact = sum(min(a.get(k, 0), b.get(k, 0)) for k in keys) / sum(max(a.get(k, 0), b.get(k, 0)) for k in keys)
    assert abs((sign[0] == sign[1]).mean() - exact) < 0.03


def test_decontaminate(spark, docs):
    items = spark.createDataFrame(
        [(1, " ".join(WORDS[50:80])), (2, "Two, WORDS"), (3, None), (4, ""), (None, LONG),
         (5, " ".join(WORDS[5:25] + ["q"] * 30))], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.contained(docs, items).collect()}
    assert got == {(1, 1), (2, 1), (3, 1), (8, 2)}
    assert decontaminate.contained(docs, items.limit(0)).count() == 0
    assert decontaminate.contained(docs.limit(0), items).count() == 0
    assert decontaminate.decontaminate(docs, items).columns == docs.columns


def test_quality(spark, docs):
    good = [(i, "This is a plain sentence. It ends well.") for i in range(60)]
    junk = [(100 + i, "%%% ### $$$ 123 | | |") for i in range(60)]
    texts = spark.createDataFrame(good + junk, "doc_id long, text string")
    labels = spark.createDataFrame(
        [(i, 1) for i, _ in good] + [(i, 0) for i, _ in junk] + [(None, 1), (3, None)],
        "doc_id long, quality int")
    trees = quality.train(texts, labels)
    held = quality.score_quality(texts, trees).filter(quality.held_out()).collect()
    assert held and all(r.predicted == int(r.doc_id < 100) for r in held)
    scored = quality.score_quality(docs, trees)
    assert scored.count() == docs.count() and scored.filter("score is null").count() == 0
    blank = quality.train(texts, labels.limit(0))
    assert {r.score for r in quality.score_quality(docs, blank).collect()} == {0.5}


def test_url_filter(spark):
    urls = [None, "", "no scheme", "http://A.Example.NET/en/x?y", "http://net", "http://net/", "x://xnet/",
            "http://example.com/de/", "http://a.org/fr/#q", "http://u://v.net/", "http://b.net/z"] + ["http://b.net/z"]
    pages = spark.createDataFrame([(i, u, "r") for i, u in enumerate(urls)], "page_id long, url string, rule string")
    rules = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]
    got = {r.page_id: (r.rule, r.verdict) for r in url_filter.filter_urls(pages, rules, buckets=3).collect()}
    assert [got[i][0] for i in range(12)] == [
        None, None, None, "example.net/en/", None, "net/", None, "example.com/de/", "org/fr/", None, "net/", "net/"]
    assert got[10][1] == "block" and got[0][1] == "allow"
    assert url_filter.filter_urls(pages.limit(0), rules).count() == 0


def test_lm_score(spark, docs):
    target = spark.createDataFrame([(1,), (None,)], "doc_id long")
    got = {r.doc_id: r for r in lm_score.score_difference(docs, target).collect()}
    assert len(got) == 9 and got[4].score == 0 and got[5].n_tokens == 0
    assert got[1].score > got[7].score
    # one bigram, seen once by each model, over a vocabulary of one context
    one = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    row = lm_score.score_difference(one, target).first()
    assert row.score == pytest.approx(0) and row.n_tokens == 1


def test_lm_score_does_not_depend_on_shards(spark, docs):
    target = spark.createDataFrame([(1,), (8,)], "doc_id long")
    whole, cut = ({r.doc_id: r for r in lm_score.score_difference(docs.repartition(n), target, 0.1, size).collect()}
                  for n, size in ((1, 1 << 21), (3, 100)))
    assert whole.keys() == cut.keys() and len(whole) == 9
    for doc, row in whole.items():
        assert tuple(row)[1:] == pytest.approx(tuple(cut[doc])[1:])


def test_lm_score_sends_a_gram_once_per_shard():
    """Not once for each document that holds it."""
    texts = pa.record_batch({"doc_id": range(500), "text": ["one two three four"] * 500})
    row, = (r for batch in lm_score.cut_shards([texts]) for r in batch.to_pylist())
    grams = lm_score.Grams(row)
    assert len(grams.hashes(lm_score.BIGRAM)) == len(grams.hashes(lm_score.CONTEXT)) == 4
    assert all(len(grams.counts(kind)[0]) == 2000 for kind in (lm_score.CONTEXT, lm_score.BIGRAM))


@pytest.mark.parametrize("few", [True, False])
def test_lm_score_equals_counting(spark, few):
    """Matched models, less a document's own counts, against plain counting."""
    rng = np.random.default_rng(9)
    texts = {i: " ".join(f"{'ab'[i % 2]}{w}" if w % 3 else "the" for w in rng.integers(0, 12, int(rng.integers(0, 30))))
             for i in range(60)}
    target = {i for i in texts if (i % 6 == 0 if few else i % 6)}
    counts = {}
    for i, text in texts.items():
        words = ["", *text.split()]
        counts[i] = Counter((1, v) for v in words[:-1]) + Counter((2, *p) for p in zip(words, words[1:]))
    size = {i: len(t.split()) for i, t in texts.items()}
    inside, outside = sum(size[i] for i in target), sum(size[i] for i in texts if i not in target)
    least = min(inside, outside)
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")

    def members(share):
        return {r.doc_id for r in frame.filter(lm_score.drawn(share) == 1).collect()}

    models = [target & members(least / inside), (texts.keys() - target) & members(least / outside)]
    assert (models[0] == target) == few and all(models)
    sums = [sum((counts[i] for i in m), Counter()) for m in models]
    v = len({g for c in counts.values() for g in c if g[0] == 1})
    ids = spark.createDataFrame([(i,) for i in target], "doc_id long")
    got = {r.doc_id: r for r in lm_score.score_difference(frame, ids).collect()}
    assert got.keys() == texts.keys()
    for i, own in counts.items():
        loss = []
        for total, held in zip(sums, models):
            left = total - own if i in held else total
            loss.append(sum(c * (np.log(left[g] + 0.1 * v) if g[0] == 1 else -np.log(left[g] + 0.1))
                            for g, c in own.items()) / max(size[i], 1))
        assert got[i].n_tokens == size[i]
        assert (got[i].target_loss, got[i].background_loss) == pytest.approx(tuple(loss))
        assert got[i].score == pytest.approx(loss[1] - loss[0])


def test_loss_text_over_many_blocks(spark):
    """Bodies that end on, before and after the border of a block."""
    texts = ["é" * n for n in (0, 4000, 4096, 4097, 1, 9000, 50)] + ["😀x<|" * 3000]
    rows = [(1, i, "assistant" if i % 2 else "user", t) for i, t in enumerate(texts)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    chats = chat_format.format_chat(turns.withColumn("parts", chat_format.text_parts(turns["text"])))
    row = chats.select("formatted", "loss_spans", chat_format.cut(
        chats["formatted"], chats["loss_spans"]).alias("cut")).first()
    assert row.cut == [row.formatted[s.start:s.end] for s in row.loss_spans]
    loss = "".join(texts[1::2])
    got = chat_format.digest(chats).first()
    assert (got.loss_chars, got.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_masking_keeps_columns_of_any_name(spark):
    frame = spark.createDataFrame(
        [(1, "password=hunter22", "mine", 17, "a", "r"), (2, None, "too", 0, "b", "s")],
        "doc_id long, text string, secrets string, n_chars int, _assign string, row string")
    masked = secrets.mask_secrets(frame)
    assert masked.schema == frame.schema
    assert [tuple(r) for r in masked.orderBy("doc_id").collect()] == [
        (1, "[secret]", "mine", 8, "a", "r"), (2, None, "too", 0, "b", "s")]
    assert secrets.mask_secrets(frame.limit(0)).count() == 0


def test_chat_round_trip(spark):
    texts = ["<|im_end|>\n<|im_start|>assistant\nok", "\\<\\|<|\\", None, "", "é😀 <\\n|", "<<||"]
    rows = [(1, i, "assistant" if i % 2 else "us\ner<|", t, 9) for i, t in enumerate(texts)] + [(2, 0, None, "x", 9)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, body int")
    chats = chat_format.format_chat(turns.withColumn("parts", chat_format.text_parts(turns["text"])))
    got = chats.withColumn("turns", chat_format.read_back(chats["formatted"])).filter("conv_id = 1").first()
    assert [(t.role, t.text) for t in got.turns] == [(r[2], r[3] or "") for r in rows[:6]]
    assert len(got.loss_spans) == 3
    assert chat_format.digest(chats).filter("conv_id = 1").first().loss_chars == sum(len(t or "") for t in texts[1::2])


def test_chat_attachments(spark):
    parts = [("text", "see ", None, None), ("image", None, "a.png", 85), ("audio", None, "b.wav", 20)]
    row = chat_format.format_chat(spark.createDataFrame(
        [(1, 0, "user", parts)], f"conv_id long, turn long, role string, parts array<{chat_format.PART}>")).first()
    assert "see <|image|><|audio|>" in row.formatted and row.expanded_tokens == 105
    assert [a.ref for a in row.attachments] == ["a.png", "b.wav"]


def test_packing(docs):
    path = public_tokenizers.path("byte_bpe_50k.json")
    pieces = packing.pack(docs, path).collect()
    held = Counter()
    for p in pieces:
        held[p.doc_id] += p.length
    for doc in {i for i, _ in ROWS}:
        assert held[doc] == sum(len(packing.ids_of([t or ""], path)[0]) for i, t in ROWS if i == doc)
    by_sequence = {}
    for p in sorted(pieces, key=lambda p: p.offset):
        assert p.offset == by_sequence.get(p.sequence_id, 0)
        by_sequence[p.sequence_id] = p.offset + p.length
    assert max(by_sequence.values()) <= 1024
    whole = {i: packing.ids_of([t or ""], path)[0] for i, t in ROWS}
    assert all(zlib.crc32(whole[p.doc_id][p.start:p.start + p.length].tobytes()) == p.ids_crc32 for p in pieces)
    assert packing.pack(docs.limit(0), path).count() == 0


def test_ids_of_chunks_are_those_of_whole_texts():
    """Also around white space of all kinds, contractions and control strings."""
    coder, dice = packing.Coder(public_tokenizers.path("byte_bpe_50k.json")), random.Random(1)
    marks = list("ab1'sS !.\n\t\r\x0b\x0c\x1c\x1f\x85\xa0\u1680\u180e\u2003\u200b\u2028\u3000\ufeffé中١²ſ\u0301😀<|>")
    marks += ["  ", "'ll", "'S", "<|endoftext|>", " \n", "word", " word", "été,"]
    texts = ["".join(dice.choices(marks, k=dice.randrange(40))) for _ in range(20_000)] + ["", " ", "x" * 99]
    assert coder.cuts
    for at in range(0, len(texts), 500):
        some = texts[at : at + 500]
        assert coder.ids(some) == list(coder.coded(some))
    assert max(map(len, coder.known)) <= packing.SHORT


def test_kept_chunks_are_bounded(monkeypatch):
    """However many distinct words a worker meets; frequent ones stay."""
    monkeypatch.setattr(packing, "KNOWN", 100)
    coder = packing.Coder(public_tokenizers.path("byte_bpe_50k.json"))
    calls = [[f"the w{i}x{j}, " for j in range(40)] for i in range(20)] + [[f"v{j} " * 2 for j in range(5000)]]
    for texts in calls:
        assert coder.ids(texts) == list(coder.coded(texts))
        assert len(coder.known) <= 200 and len(coder.older) <= 200
    assert "the" in coder.known or "the" in coder.older


def test_texts_may_hold_the_mark_between_chunks():
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    plain, m = Tokenizer.from_file(path), packing.MARK
    texts = [f"a{m}b {m} c", m, m * 3, f"x {m}\n{m}y, plain words", "plain words"]
    got = [x.tolist() for x in packing.ids_of(texts, path)]
    assert got == [plain.encode(t, add_special_tokens=False).ids + [0] for t in texts]


def test_words_are_coded_once():
    class Counting:
        def __init__(self, inner):
            self.inner, self.chars = inner, 0

        def encode_batch_fast(self, texts, **options):
            self.chars += sum(map(len, texts))
            return self.inner.encode_batch_fast(texts, **options)

    path = public_tokenizers.path("byte_bpe_50k.json")
    coders = {path: packing.Coder(path)}
    counting = coders[path].tokenizer = Counting(coders[path].tokenizer)
    for _ in range(3):
        packing.ids_of(["alpha, beta\n" * 1000, "beta alpha"], path, coders)
    assert counting.chars < 100


def test_licenses(spark, docs):
    texts = spark.createDataFrame(
        [(1, "é\nreleased under the MIT license.\nmore"), (2, "my driving license"), (3, None),
         (4, "Licensed under the Apache License, Version 2.0")], "doc_id long, text string")
    got = {r.doc_id: r for r in licenses.scan_licenses(texts).collect()}
    assert {k: v.license for k, v in got.items()} == {1: "MIT", 4: "Apache-2.0"}
    assert (got[1].start, got[1].end) == (2, 32)
    assert licenses.scan_licenses(docs).count() == 0


def test_secrets(spark, docs):
    key = "aZ3k9QpL0xVb7TnR2wYc8MfH5sJd1GuE"
    texts = ["é password = hunter22 Token:abc", "AKIA" + "A1B2" * 5, "0123456789abcdef0123456789", f"x {key} y",
             "api_key='abcdef' " + "secret=abcdefg " * 3, "", None, "thththththththththththththth1"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: [(s.kind, s.start, s.end) for s in r.secrets] for r in secrets.scan_secrets(frame).collect()}
    pattern = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    for i, t in enumerate(texts):
        expected = [("assign", m.start(), m.end()) for m in pattern.finditer(t or "") if len(m[2]) >= 6]
        assert [s for s in got[i] if s[0] == "assign"] == expected
    assert got[1] == [("access", 0, 24)] and got[2] == [("hex", 0, 26)]
    assert got[3] == [("random", 2, 2 + len(key))] and got[5] == got[6] == got[7] == []
    masked = {r.doc_id: r.text for r in secrets.mask_secrets(frame).collect()}
    assert masked[3] == "x [secret] y" and masked[6] is None and masked[7] == texts[7]
    assert secrets.mask_secrets(docs).count() == docs.count()


def test_vectors(spark):
    rng = np.random.default_rng(5)
    base = rng.standard_normal((40, 16))
    rows = [(i, v.tolist()) for i, v in enumerate(base)]
    rows += [(100 + i, (base[i % 20] + 0.02 * rng.standard_normal(16)).tolist()) for i in range(60)]
    rows += [(200 + i, base[0].tolist()) for i in range(30)]
    odd = [(300, None), (301, []), (302, [0.0] * 16), (303, [float("nan")] * 16), (304, [None] * 16)]
    frame = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>")
    got = {r.vec_id: r for r in vectors.near_vectors(frame, window=128).collect()}
    ids = [i for i, _ in rows]
    m = np.array([v for _, v in rows], dtype=np.float32).astype(float)
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    near = (m @ m.T >= 0.95).sum(axis=1) - 1
    assert [got[i].n_links for i in ids] == near.tolist()
    assert all(got[i].n_links == 0 and got[i].kept for i, _ in odd)
    assert got[200].component_id == 0 and not got[200].kept
    assert vectors.near_vectors(frame.limit(0)).count() == 0


def test_pipeline(spark):
    rows = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert rows.count() > 0
    assert [name for name, _ in corpus_pipeline.STAGES][0] == "quality_classifier"


def words_in(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def test_stages_equal_brute_force(spark):
    """The middle stages on all test documents and planted rows, each on its
    own input, against plain Python."""
    folder = "/root/testdata/sf0.001"
    given = spark.read.parquet(f"{folder}/documents.parquet")
    items = [r.text for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    rows = [r.asDict() for r in given.collect()]
    top = max(r["doc_id"] for r in rows) + 1
    planted = [rows[0]["text"], rows[0]["text"] + " and more", "intro " + items[0] + " outro",
               "password: hunter22 AKIA" + "A1" * 9 + " secret=abcdefg0123456789abcdef01234567 end", "", None]
    rows += [{**rows[0], "doc_id": top + i, "text": t} for i, t in enumerate(planted)]
    docs = spark.createDataFrame(rows, given.schema)

    usable = [(r["doc_id"], r["text"]) for r in rows if r["text"] is not None]
    want = {*brute_classes(usable)} | {r["doc_id"] for r in rows if r["text"] is None}
    distinct = corpus_pipeline.keep_distinct(spark, docs, folder)
    assert distinct.schema == docs.schema
    assert sorted(r.doc_id for r in distinct.collect()) == sorted(want)
    assert top not in want

    def shingles(words, n):
        return {tuple(words[i:i + n]) for i in range(len(words) - n + 1)}

    def leaks(text):
        held = words_in(text)
        for item in map(words_in, items):
            n = min(5, len(item))
            if n and len(shingles(item, n) & shingles(held, n)) >= 0.8 * len(shingles(item, n)) - 1e-12:
                return True
        return False

    clean = corpus_pipeline.drop_benchmark(spark, docs, folder)
    assert clean.columns == docs.columns
    assert sorted(r.doc_id for r in clean.collect()) == sorted(r["doc_id"] for r in rows if not leaks(r["text"]))
    assert leaks(planted[2])

    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)

    def masked(text):
        spans = [m.span() for m in assign.finditer(text) if len(m[2]) >= 6]
        spans += [m.span() for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
        spans += [m.span() for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
        out, at = "", 0
        for start, end in sorted(spans):
            if start >= at:
                out += text[at:start] + "[secret]"
            at = max(at, end)
        return out + text[at:]

    safe = {r.doc_id: r.text for r in corpus_pipeline.mask_secrets(spark, docs, folder).collect()}
    assert safe == {r["doc_id"]: r["text"] if r["text"] is None else masked(r["text"]) for r in rows}
    assert safe[top + 3] == "[secret] [secret] [secret] end"


def test_joined_roots_finds_all_roots_that_meet(spark):
    """Blocks of two nodes against every pair compared."""
    rng = np.random.default_rng(5)
    base = [int(x) for x in rng.integers(0, 10**6, 40)]
    marks = {n: sorted(set(base[: 30 + n % 8] + [int(x) for x in rng.integers(10**7, 10**8, n % 9)])) for n in range(40)}
    root = {n: n if n % 3 else 0 for n in marks}
    nodes = spark.createDataFrame([(n, len(m), m) for n, m in marks.items()], "node long, size int, marks array<long>")
    placed = spark.createDataFrame(
        [(k, n % 16, n, len(marks[n]), root[n]) for n in marks for k in (1, 2) if k == 1 or n < 10],
        "key long, salt int, node long, size int, root long")
    want = {
        frozenset((root[a], root[b])) for a in marks for b in marks if root[a] != root[b]
        and len({*marks[a]} & {*marks[b]}) >= 0.8 * len({*marks[a]} | {*marks[b]}) - 1e-12}
    got = {frozenset(r) for r in minhash.joined_roots(placed, nodes, 0.8, block=2).collect()}
    assert got == want and want
    none = placed.filter("key < 0")
    assert minhash.joined_roots(none, nodes, 0.8).count() == 0
