"""Bounded-space online packing of token ids into sequences."""

from __future__ import annotations

import json
import os
import re
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from scriptorium.llm.common import stored

LENGTH, OPEN, BATCH = 1024, 64, 16
# Chunks kept in each of a worker's two tables (about 35 MB), and their longest; what ends a text.
KNOWN, SHORT, END = 1 << 18, 32, bytes(4)
MARK = "\U0010ffff"  # stands between chunks that are coded by one call
CHUNK = re.compile(
    r"\n(?=\S)| ?[A-Za-zÀ-ÖØ-öø-ſ]++(?=[!-/:-@\[-`{-~ \t\n\r])"
    r"|\s*+\S++(?:[^\S \t\n\r]\s*+\S*+)*+|\s+")
PIECE = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long, ids binary, part long"
)
LEFT = 1 << 62


class Windows:
    """A fixed number of open windows; a piece goes where it leaves least room,
    and when it fits nowhere the fullest window is emitted."""

    def __init__(self, length: int, limit: int):
        self.length, self.limit = length, limit
        self.rooms: list[tuple[int, int]] = []  # (room, window), sorted
        self.held: dict[int, list] = {}
        self.next = 0

    def place(self, piece: tuple, size: int) -> Iterator[tuple[int, list]]:
        at = bisect_left(self.rooms, (size, -1))
        if at < len(self.rooms):
            room, window = self.rooms.pop(at)
        else:
            if len(self.rooms) >= self.limit:
                _, full = self.rooms.pop(0)
                yield full, self.held.pop(full)
            room, window = self.length, self.next
            self.next += 1
            self.held[window] = []
        self.held[window].append(piece)
        if room == size:
            yield window, self.held.pop(window)
        else:
            insort(self.rooms, (room - size, window))


class Coder:
    """Token ids by a tokenizer; short chunks of text coded before are kept.

    They are kept in two tables: when the first is full it becomes the second,
    whose chunks go back to the first when they are met again. So a worker's
    memory does not grow with the rows, and frequent chunks stay.

    A byte-level tokenizer cuts a text by a fixed pattern before it merges
    bytes. It always cuts between a character that is no white space and a
    blank, tab or line break, between a letter and ASCII punctuation and after
    a single line break, so texts are cut there first: the ids of a text are
    those of its chunks in order. Other white space does not end a chunk. Of
    tokenizers with another pattern or steps before it, whole texts are coded.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import AddedToken, Tokenizer

        def made():
            tokenizer = Tokenizer.from_file(path)
            tokenizer.encode_special_tokens = True
            return tokenizer

        self.tokenizer, self.made, self.plain = made(), made, None
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        steps = json.loads(self.tokenizer.to_str())
        before = steps["pre_tokenizer"] or {}
        self.cuts = (
            before.get("type") == "ByteLevel" and before.get("use_regex", True)
            and not before["add_prefix_space"] and not steps["normalizer"] and not steps["truncation"]
            and not steps["padding"] and steps["model"]["type"] == "BPE" and not steps["model"]["dropout"]
            and all(x["special"] for x in steps["added_tokens"]))
        if self.cuts:
            self.tokenizer.add_tokens([AddedToken(MARK, normalized=False, special=False)])
            self.mark = self.tokenizer.token_to_id(MARK)

    def coded(self, texts: list[str]) -> Iterator[bytes]:
        tokenizer = self.tokenizer
        if self.cuts and any(MARK in t for t in texts):
            tokenizer = self.plain = self.plain or self.made()
        for code in tokenizer.encode_batch_fast(texts, add_special_tokens=False):
            yield np.array(code.ids, dtype="<u4").tobytes()

    def coded_chunks(self, chunks: list[str]) -> dict[str, bytes]:
        """The ids of each, by one call: added tokens part a text before all else."""
        out = {x: next(self.coded([x])) for x in chunks if MARK in x}
        chunks = [x for x in chunks if x not in out]
        for code in self.tokenizer.encode_batch_fast(
                ["".join(x + MARK for x in chunks)], add_special_tokens=False):
            ids = np.array(code.ids, dtype="<u4")
            ends, raw, start = np.flatnonzero(ids == self.mark).tolist(), ids.tobytes(), 0
            for x, end in zip(chunks, ends, strict=True):
                out[x] = raw[4 * start : 4 * end]
                start = end + 1
        return out

    def ids(self, texts: list[str]) -> list[bytes]:
        if not self.cuts:
            return list(self.coded(texts))
        cut = [CHUNK.findall(t) for t in texts]
        new = set().union(*cut).difference(self.known)
        here = {x: self.older[x] for x in new if x in self.older}
        here |= self.coded_chunks([x for x in new if x not in here])
        self.known.update(here)
        out = [b"".join(map(self.known.__getitem__, c)) for c in cut]
        for x in here:
            if len(x) > SHORT or len(here) > KNOWN:
                del self.known[x]
        if len(self.known) > KNOWN:
            self.older, self.known = self.known, {}
        return out


def ids_of(texts: list[str], path: str, coders: dict = {}) -> list[np.ndarray]:
    """Per text its ids and the id 0."""
    if path not in coders:
        coders[path] = Coder(path)
    return [np.frombuffer(c + END, dtype="<u4") for c in coders[path].ids(texts)]


def piece_row(doc, start, ids, total, sequence, offset, part, keep):
    raw = ids.tobytes()
    return (doc, start, len(ids), zlib.crc32(raw), total, sequence, offset, raw if keep else None, part)


def arrow(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(list(x), t) for x, t in zip(zip(*rows), ARROW)], names=COLUMNS)


def pack(docs: DataFrame, tokenizer: str, length: int = LENGTH, open_windows: int = OPEN) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset``.

    Each partition packs its rows as they come: whole lengths of a long
    document are sequences of their own, the rest goes best-fit into at most
    ``open_windows`` open windows. Windows still open at a partition's end are
    merged in groups of 64 partitions by running their pieces on end to end,
    cutting at the sequence bound, so only a group's last sequence is short.
    Per task the ids of one batch and of the open windows are held.

    A null or empty text is the single id 0. Repeated rows are packed each.
    Null ids stay null. No input rows, no pieces. ``padded_length`` gives what
    a sequence of some size is padded to.
    """

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        windows, out = Windows(length, open_windows), []
        base = part << 36

        def emit(window: int, pieces: list, keep: bool = False):
            offset = 0
            for doc, start, ids, total in pieces:
                out.append(piece_row(
                    doc, start, ids, total, base + window, offset, part >> 6, keep))
                offset += len(ids)

        for batch in batches:
            for begin in range(0, batch.num_rows, BATCH):
                docs, texts = (batch.column(c).slice(begin, BATCH).to_pylist() for c in ("doc_id", "text"))
                for doc, ids in zip(docs, ids_of([t or "" for t in texts], tokenizer)):
                    for start in range(0, len(ids), length):
                        # A copy: a window's piece would hold its whole document.
                        piece = ids[start : start + length].copy()
                        for window, pieces in windows.place((doc, start, piece, len(ids)), len(piece)):
                            emit(window, pieces)
                if len(out) >= 4096:
                    yield arrow(out)
                    out.clear()
        for window, pieces in sorted(windows.held.items()):
            emit(window, pieces, keep=True)
        if out:
            yield arrow(out)

    def merged(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["sequence_id", "offset"], kind="stable")
        part, at, out = int(group["part"].iloc[0]), 0, []
        for row in group.itertuples(index=False):
            ids, start = np.frombuffer(row.ids, dtype="<u4"), int(row.start)
            doc = None if pd.isna(row.doc_id) else int(row.doc_id)
            while len(ids):
                take = min(len(ids), length - at % length)
                out.append(piece_row(
                    doc, start, ids[:take], int(row.doc_tokens),
                    LEFT + (part << 36) + at // length, at % length, part, False))
                at, start, ids = at + take, start + take, ids[take:]
        return pd.DataFrame(out, columns=COLUMNS)

    first = stored(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(rows_of, PIECE), "pieces")
    rest = first.filter("ids is not null").groupBy("part").applyInPandas(merged, PIECE)
    pieces = first.filter("ids is null").unionByName(rest)
    return pieces.drop("ids", "part")


COLUMNS = [c.split()[0] for c in PIECE.split(", ")]
ARROW = [{"long": pa.int64(), "binary": pa.binary()}[c.split()[1]] for c in PIECE.split(", ")]


def padded_length(size, length: int = LENGTH):
    """``length``, or the sequence's own length where that is a power of two."""
    return F.when(F.bit_count(size) == 1, size).otherwise(F.lit(length))
