"""Hashes of words and pairs, dealt by range and sent as compressed bytes."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import zstandard


def pack(numbers: np.ndarray) -> bytes:
    """Numbers from 0 as compressed bytes: all lowest bytes first, then the next."""
    return zstandard.compress(numbers.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes())


def unpack(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(packed), dtype=np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<u8").ravel()


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit number for a number, its bits mixed."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(words: Iterable[str]) -> np.ndarray:
    return np.array([int.from_bytes(hashlib.blake2b(
        w.encode("utf-8", "surrogatepass"), digest_size=8).digest()) for w in words], dtype=np.uint64)


def pair_hashes(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return mixed(first * np.uint64(0x9E3779B97F4A7C15) + second * np.uint64(0xD6E8FEB86659FD93))


def bucketed(hashes: np.ndarray, buckets: int, bits: int = 64) -> Iterator[tuple[int, np.ndarray, bytes]]:
    """Per bucket, a range of hashes below ``2 ** bits``: the places of its
    hashes in order, and these packed by their differences."""
    order = np.argsort(hashes, kind="stable")
    bounds = np.array([(i << bits) // buckets for i in range(1, buckets)], dtype=np.uint64)
    for bucket, at in enumerate(np.split(order, np.searchsorted(hashes[order], bounds))):
        if len(at):
            yield bucket, at, pack(np.diff(hashes[at], prepend=np.uint64(0)))
