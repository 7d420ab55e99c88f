"""Words of whole texts as arrays of 64-bit hashes, a block of documents at a time.

A word is a run of bytes other than ``[\\x20\\x09-\\x0D]`` in UTF-8. Each block is one flat
byte array, so no step runs Python code per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 1 << 19
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def combine(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """An order-sensitive hash of two hashes."""
    return mix(left * np.uint64(0xD6E8FEB86659FD93) + right)


class Powers:
    """Powers of the hash base and of its inverse, grown to the longest block so far."""

    up = np.ones(1, np.uint64)
    down = np.ones(1, np.uint64)

    @classmethod
    def upto(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            size = max(n, BLOCK_BYTES + (1 << 16))
            for name, base in (("up", _BASE), ("down", _INVERSE)):
                steps = np.full(size, base)
                steps[0] = 1
                setattr(cls, name, np.multiply.accumulate(steps))
        return cls.up, cls.down


def blocks(texts: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes of text; a longer text is a range of its own."""
    sizes = pc.binary_length(pc.fill_null(texts, "")).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    start = 0
    while start < len(sizes):
        base = ends[start] - sizes[start]
        stop = max(start + 1, int(np.searchsorted(ends, base + limit, "right")))
        yield start, stop
        start = stop


def _flat(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    offsets = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(x) for x in texts], out=offsets[1:])
    return np.frombuffer(b"".join(texts), np.uint8), offsets


def encoded(texts: pa.Array, lower: bool = False) -> list[bytes]:
    """UTF-8 of every text, null as empty; ``lower`` lower-cases A-Z only."""
    raw = pc.cast(pc.fill_null(texts, ""), pa.binary()).to_pylist()
    return [x.lower() for x in raw] if lower else raw


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and where each document's words begin (n + 1 values)."""
    data, offsets = _flat(texts)
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    up, down = Powers.upto(len(data))
    inside = ~_SPACE[data]
    before = np.empty_like(inside)
    before[0] = False
    before[1:] = inside[:-1]
    before[offsets[:-1][offsets[:-1] < len(data)]] = False
    after = np.empty_like(inside)
    after[-1] = False
    after[:-1] = inside[1:]
    after[offsets[1:][offsets[1:] > 0] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    hashes = mix((sums[ends] - sums[starts]) * down[starts])
    return hashes, np.searchsorted(starts, offsets)


def with_end(hashes: np.ndarray, bounds: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The same with one ``end`` token after each document's words."""
    return np.insert(hashes, bounds[1:], np.uint64(end)), bounds + np.arange(len(bounds))


class HashIndex:
    """A fixed set of 64-bit keys with open addressing; finds many keys per call."""

    def __init__(self, keys: np.ndarray) -> None:
        self.keys = np.asarray(keys, np.uint64)
        bits = max(4, int(len(self.keys) * 3).bit_length())
        self.shift = np.uint64(64 - bits)
        self.mask = np.int64((1 << bits) - 1)
        self.slots = np.full(1 << bits, -1, np.int32)
        self.longest = 0
        left = np.arange(len(self.keys))
        at = (mix(self.keys) >> self.shift).astype(np.int64)
        while len(left):
            self.longest += 1
            free = self.slots[at] < 0
            self.slots[at[free]] = left[free]
            lost = self.slots[at] != left
            left, at = left[lost], (at[lost] + 1) & self.mask

    def find(self, wanted: np.ndarray) -> np.ndarray:
        """Position of each wanted key in ``keys``, or -1."""
        if not len(self.keys):
            return np.full(len(wanted), -1, np.int32)
        at = (mix(wanted) >> self.shift).astype(np.int64)
        found = self.slots[at]
        open_ = np.flatnonzero((found >= 0) & (self.keys[found] != wanted))
        for _ in range(self.longest):
            if not len(open_):
                break
            at[open_] = (at[open_] + 1) & self.mask
            found[open_] = self.slots[at[open_]]
            tried = found[open_]
            open_ = open_[(tried >= 0) & (self.keys[tried] != wanted[open_])]
        found[open_] = -1
        return found


class Tally:
    """Counts of keys over many blocks, with an array of values for each key; it folds when it has
    grown, so memory stays bounded."""

    def __init__(self, limit: int = 1 << 19) -> None:
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.size, self.limit = 0, limit

    def add(self, keys: np.ndarray, *values: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        """Count ``keys``; gives ``(keys, counts, *values)`` out when folding frees too little."""
        part = (keys, np.ones(len(keys), np.int64), *values) if values else np.unique(keys, return_counts=True)
        self.parts.append(part)
        self.size += len(part[0])
        if self.size > self.limit:
            folded = self.rest()
            if len(folded[0]) > self.limit // 2:
                yield folded
            else:
                self.parts, self.size = [folded], len(folded[0])

    def rest(self) -> tuple[np.ndarray, ...]:
        """Everything counted so far, which is then forgotten."""
        parts, self.parts, self.size = self.parts, [], 0
        if not parts:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        keys, counts, *values = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.argsort(keys)
        keys = keys[order]
        first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))[: len(keys)]
        counts = np.add.reduceat(counts[order], first) if len(first) else counts
        return keys[first], counts, *(v[order[first]] for v in values)
