"""License scans by conditional compression against templates."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame

# Wordings of common license notices, by SPDX name.
TEMPLATES = {
    "MIT": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files",
    ],
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0."],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3."],
    "GPL-2.0": ["This work is licensed under the GNU General Public License, version 2."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0."],
    "CC-BY-4.0": ["Licensed under CC BY 4.0."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0."],
    "BSD-3-Clause": [
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met",
    ],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
}
TOKEN = re.compile(r"[\w]+(?:[.-]\w+)*")
HINT = re.compile(r"licen[sc]e|permission|redistribution|copyright|cc|mit|apache|mozilla|gnu|by-|\d", re.I)
LEAST, LEVEL = 0.8, 19
SCHEMA = (
    "doc_id long, license string, start long, end long, reduction double, similarity double, "
    "missing array<string>, added array<string>"
)


def words(text: str) -> list[str]:
    return [m.group().lower() for m in TOKEN.finditer(text)]


class Wording:
    """A template's words, prepared for the search of runs that fit it.

    ``longest`` is the most words a run of similarity ``least`` can have, and
    ``need`` the fewest template words it holds. So it lacks too few to avoid
    all ``anchors``, the template's most telling words.
    """

    def __init__(self, name: str, text: str, least: float):
        self.name, self.text, self.words, self.least = name, text, words(text), least
        m = len(self.words)
        self.need = max(math.ceil(least * m - 1e-9), 1)
        self.longest = int(m / least + 1e-9)
        telling = sorted(self.words, key=lambda w: (HINT.search(w) is None, -len(w), w))
        self.anchors = set(telling[: m - self.need + 1])
        self.held, self.bits = Counter(self.words), {}
        for i, w in enumerate(self.words):
            self.bits[w] = self.bits.get(w, 0) | 1 << i

    def runs(self, own: list[str], blocks: list[tuple[int, int]]):
        """``(similarity, first word, end word)`` of the runs of at least
        ``least`` that begin in one of the sorted blocks, without those that
        only add words to a better one."""
        last = -1
        for first, end in blocks:
            for i in range(max(first, last + 1), end):
                last = i
                if own[i] in self.bits and self.enough(own, i):
                    yield from self.from_word(own, i, len(self.words))

    def enough(self, own: list[str], i: int) -> bool:
        seen = Counter(w for w in own[i : i + self.longest] if w in self.bits)
        return sum(min(n, self.held[w]) for w, n in seen.items()) >= self.need

    def from_word(self, own: list[str], i: int, m: int):
        # Common subsequences of the template and each run from word i on, as
        # bits: a zero is a step of the length.
        full = open_ = (1 << m) - 1
        length = 0
        for j in range(i, min(i + self.longest, len(own))):
            met = open_ & self.bits.get(own[j], 0)
            if not met:
                continue
            open_ = (open_ + met | open_ - met) & full
            if (now := m - open_.bit_count()) > length:
                length = now
                similarity = length / (m + j + 1 - i - length)
                if similarity >= self.least:
                    yield similarity, i, j + 1


def differences(block: list[str], template: list[str]) -> tuple[list[str], list[str]]:
    """The template's words that a longest common subsequence lacks, and the
    block's words that it does not use."""
    n, m = len(block), len(template)
    rest = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        for j in range(m - 1, -1, -1):
            rest[i][j] = rest[i + 1][j + 1] + 1 if block[i] == template[j] else max(rest[i + 1][j], rest[i][j + 1])
    i = j = 0
    missing, added = [], []
    while i < n and j < m:
        if block[i] == template[j]:
            i, j = i + 1, j + 1
        elif rest[i][j + 1] >= rest[i + 1][j]:
            missing.append(template[j])
            j += 1
        else:
            added.append(block[i])
            i += 1
    return missing + template[j:], added + block[i:]


def scan_licenses(docs: DataFrame, templates: dict | None = None, least: float = LEAST) -> DataFrame:
    """One row per notice found: its document, license, span in code points
    (end exclusive), size reduction, similarity and wording differences.

    Candidates are blocks of words around the wordings' telling words, across
    line ends, cut to the size of a wording. Each is compressed alone and with
    every wording of that size as a raw zstandard dictionary (lower-cased words,
    one space between them). Only wordings that save bytes on a block are looked
    for in it. As a block is no longer than the runs that hold its telling word,
    the saving does not depend on the length of the text.

    Word differences confirm: the similarity of a run of the block to a wording
    is the length of their longest common subsequence over the wording's words
    and the run's added ones; at least ``least`` is needed. Per wording the runs
    of highest similarity count. Of overlapping runs of several wordings that
    one is a row which compression with its wording shrinks by the most bytes,
    then the higher similarity, the longer wording, the smaller name, the
    earlier start and end; then the other wordings are looked for in what is
    left. ``reduction`` is the share of bytes saved on the run's own text. Null
    or empty texts give no rows; repeated rows repeat theirs.
    """
    wordings = [
        w for n, ts in sorted((templates or TEMPLATES).items()) for t in ts if (w := Wording(n, t, least)).words]
    anchors = sorted({a for w in wordings for a in w.anchors})
    telling = set(anchors)
    sizes: dict[int, list[Wording]] = {}
    for w in wordings:
        sizes.setdefault(w.longest, []).append(w)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import zstandard as z

        plain = z.ZstdCompressor(level=LEVEL)
        primed, primed_words = ({w: z.ZstdCompressor(level=LEVEL, dict_data=z.ZstdCompressionDict(
            text.encode(), dict_type=z.DICT_TYPE_RAWCONTENT)) for w, text in of.items()} for of in (
                {w: w.text for w in wordings}, {w: " ".join(w.words) for w in wordings}))

        def shrunk(own: list[str], places: dict[str, list[int]]) -> dict[Wording, list[tuple[int, int]]]:
            """Per wording the blocks that it saves bytes on."""
            out = {}
            for longest, alike in sizes.items():
                held = sorted({p for a in {a for w in alike for a in w.anchors} for p in places.get(a, ())})
                for p in held:
                    # All runs of up to this size that hold the word.
                    first, end = max(p - longest + 1, 0), min(p + longest, len(own))
                    raw = " ".join(own[first:end]).encode("utf-8", "replace")
                    alone = len(plain.compress(raw))
                    for w in alike:
                        if len(primed_words[w].compress(raw)) < alone:
                            out.setdefault(w, []).append((first, end))
            return out

        def notices(text: str):
            tokens = [m.span() for m in TOKEN.finditer(text)]
            own = [text[a:b].lower() for a, b in tokens]
            places: dict[str, list[int]] = {}
            for at, w in enumerate(own):
                if w in telling:
                    places.setdefault(w, []).append(at)
            runs = {w: sorted(w.runs(own, blocks), key=lambda r: (-r[0], *r[1:]))
                    for w, blocks in shrunk(own, places).items()}
            taken = bytearray(len(own))
            while runs:
                ranked = []
                for w, found in runs.items():
                    seen = bytearray(taken)
                    for s, i, j in found:
                        if not any(seen[i:j]):
                            seen[i:j] = b"\1" * (j - i)
                            raw = text[tokens[i][0] : tokens[j - 1][1]].encode("utf-8", "replace")
                            alone, given = len(plain.compress(raw)), len(primed[w].compress(raw))
                            ranked.append((given - alone, -s, -len(w.words), w.name, i, j, 1 - given / alone, w))
                for _, s, _, name, i, j, gain, w in sorted(ranked, key=lambda r: r[:6]):
                    if not any(taken[i:j]):
                        taken[i:j] = b"\1" * (j - i)
                        yield (name, tokens[i][0], tokens[j - 1][1], gain, -s, *differences(own[i:j], w.words))
                left = {w: [r for r in found if not any(taken[r[1] : r[2]])] for w, found in runs.items()}
                runs = {w: found for w, found in left.items() if found}

        for frame in frames:
            out = []
            for doc, text in zip(frame["doc_id"], frame["text"]):
                if not text:
                    continue
                low = text.lower()
                if not any(a in low for a in anchors):
                    continue
                doc = None if pd.isna(doc) else int(doc)
                out += [(doc, *h) for h in notices(text)]
            yield pd.DataFrame(out, columns=[
                "doc_id", "license", "start", "end", "reduction", "similarity", "missing", "added"])

    return docs.select("doc_id", "text").mapInPandas(run, SCHEMA)
