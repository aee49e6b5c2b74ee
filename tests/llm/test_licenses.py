"""License notices in long, wrapped and shared lines, and against brute force."""

from __future__ import annotations

import random
import sys
import textwrap

import pandas as pd

from scriptorium.llm import licenses


def scanned(spark, *texts, **settings):
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = licenses.scan_licenses(frame, **settings).collect()
    return sorted((r.doc_id, r.start, r.end, r.license, r.similarity) for r in rows)


def test_result_does_not_depend_on_the_length_of_the_line(spark):
    notice = "This work is licensed under the GNU General Public License, version 3."
    altered = notice.replace("This", "That")
    around = "this is the work of a general public under version control " * 1000
    got = scanned(spark, notice, around + notice + " " + around, altered, around + altered + " " + around)
    assert [(r[0], r[3], r[4]) for r in got] == [
        (0, "GPL-3.0", 1.0), (1, "GPL-3.0", 1.0), (2, "GPL-3.0", 11 / 12), (3, "GPL-3.0", 11 / 12)]
    assert got[1][1:3] == (len(around), len(around) + len(notice) - 1)


def test_every_notice_of_a_line_is_a_row(spark):
    two = "Released under the MIT License. Licensed under the Apache License, Version 2.0."
    got = scanned(spark, two, "Licensed under CC BY 4.0. " * 3)
    assert [r[3] for r in got] == ["MIT", "Apache-2.0"] + ["CC-BY-4.0"] * 3
    assert got[1][1:3] == (two.index("Licensed"), len(two) - 1)


def test_wrapped_originals_of_all_templates(spark):
    mit = (
        "MIT License\n\nCopyright (c) 2024 A. Author\n\nPermission is hereby granted, free of charge, to any "
        "person obtaining a copy\nof this software and associated documentation files (the \"Software\"), to deal\n")
    bsd = (
        " * Redistribution and use in source and binary forms, with or without\n * modification, are permitted "
        "provided that the following conditions are met:\n")
    mpl = (
        "/* This Source Code Form is subject to the terms of the Mozilla Public\n * License, v. 2.0. If a copy "
        "of the MPL was not distributed with this\n * file, You can obtain one at https://mozilla.org/MPL/2.0/. */\n")
    got = scanned(spark, mit, bsd, mpl)
    assert [(r[0], r[3], r[4]) for r in got] == [(0, "MIT", 1.0), (1, "BSD-3-Clause", 1.0), (2, "MPL-2.0", 1.0)]
    for name, wordings in licenses.TEMPLATES.items():
        for wording in wordings:
            for width in (20, 45):
                text = "# a\n" + "\n".join("# " + x for x in textwrap.wrap(wording, width)) + "\n# b"
                assert [r[3:] for r in scanned(spark, text)] == [(name, 1.0)]


def brute(text: str, wordings: list[tuple[str, str]], least: float):
    """All runs of words against all wordings, the best first."""
    places = [m.span() for m in licenses.TOKEN.finditer(text)]
    own, found = licenses.words(text), []
    for name, wording in wordings:
        t = licenses.words(wording)
        for i in range(len(own)):
            row = [0] * (len(t) + 1)
            for j in range(i, min(len(own), i + 3 * len(t))):
                new = [0]
                for k, w in enumerate(t):
                    new.append(row[k] + 1 if w == own[j] else max(row[k + 1], new[k]))
                row = new
                if (s := row[-1] / (len(t) + j + 1 - i - row[-1])) >= least:
                    found.append((-s, -len(t), i, j + 1, name))
    out, taken = [], set()
    for s, _, i, j, name in sorted(found):
        if not taken & set(range(i, j)):
            taken |= set(range(i, j))
            out.append((places[i][0], places[j - 1][1], name, -s))
    return sorted(out)


def test_scan_against_all_runs_of_words(spark):
    # Wordings of unlike lengths, so that no tie is left to the reduction.
    held = {"A": ["one two three four two five"], "B": ["red green blue red license"], "C": ["p q r s t u v w x y"]}
    rng, texts = random.Random(7), []
    pool = sorted({w for ts in held.values() for t in ts for w in t.split()}) + ["other"]
    for _ in range(60):
        parts = []
        for _ in range(6):
            part = rng.choice(list(held.values()))[0].split()
            for _ in range(rng.randint(0, 3)):
                at = rng.randrange(len(part))
                part[at : at + rng.randint(0, 1)] = rng.choices(pool, k=rng.randint(0, 1))
                part = part or ["other"]
            parts += part + rng.choices(pool, k=rng.randint(0, 3))
        texts.append("".join(w + rng.choice([" ", "\n", ", "]) for w in parts))
    want = [(d, *r) for d, t in enumerate(texts) for r in brute(t, [(n, x) for n, xs in held.items() for x in xs], 0.8)]
    assert scanned(spark, *texts, templates=held) == want and len(want) > 100


class Stub:
    """In place of zstandard: a dictionary saves what ``savings`` says, else nothing."""

    savings: dict[str, int] = {}
    DICT_TYPE_RAWCONTENT = None

    @staticmethod
    def ZstdCompressionDict(raw, dict_type):
        return raw.decode().lower()

    class ZstdCompressor:
        def __init__(self, level, dict_data=""):
            self.saved = next((n for end, n in Stub.savings.items() if dict_data.rstrip(".").endswith(end)), 0)

        def compress(self, raw):
            return b"0" * (100 - self.saved)


def stubbed(monkeypatch, savings, text):
    """The scan of one text in this process, without Spark."""
    class Docs:
        def select(self, *columns):
            return self

        def mapInPandas(self, run, schema):
            return pd.concat(run(iter([pd.DataFrame({"doc_id": [1], "text": [text]})])))

    monkeypatch.setitem(sys.modules, "zstandard", Stub)
    monkeypatch.setattr(Stub, "savings", savings)
    return licenses.scan_licenses(Docs())["license"].tolist()


def test_compression_selects_blocks_and_licenses(monkeypatch):
    text = "a b " + licenses.TEMPLATES["GPL-3.0"][0] + " c d"
    assert stubbed(monkeypatch, {}, text) == []
    assert stubbed(monkeypatch, {"version 3": 9, "version 2": 5}, text) == ["GPL-3.0"]
    assert stubbed(monkeypatch, {"version 3": 5, "version 2": 9}, text) == ["GPL-2.0"]
    assert stubbed(monkeypatch, {"version 2": 9}, text) == ["GPL-2.0"]
    # Word differences confirm: no saving makes another text a notice.
    assert stubbed(monkeypatch, {"version 3": 9}, "licensed by a gnu under a license of the public") == []


def test_wordings_that_differ_in_one_word_are_told_apart(spark):
    texts, want = [], []
    for name, wordings in licenses.TEMPLATES.items():
        for wording in wordings:
            w = wording.split()
            for cut in range(len(w) + 1):
                if cut == len(w) or len(w) > 6 and w[cut].lower() not in ("2.", "3."):
                    texts.append(" ".join(["Some", "lines", *w[:cut], *w[cut + 1 :], "and", "others"]))
                    want.append(name)
    assert [r[3] for r in scanned(spark, *texts)] == want
