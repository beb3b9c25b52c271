"""Whole batches of texts as numpy arrays: bytes, words, spans, 64-bit hashes and a table keyed by them.

Everything here is a small helper that runs inside one Arrow batch of one task. Hashes are 64-bit,
so two different strings are taken for one with a chance of about n * n / 2**65 over n strings.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Text handled at once: its arrays, of some 8 bytes a character each, stay in the processor's caches.
SLICE_BYTES = 300_000

_ODD = np.uint64(0x9E3779B97F4A7C15)  # the base of the polynomial; odd, so that it has an inverse
_INVERSE = np.uint64(pow(int(_ODD), -1, 1 << 64))


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the splitmix64 finisher)."""
    out = values ^ (values >> np.uint64(30))
    out *= np.uint64(0xBF58476D1CE4E5B9)
    out ^= out >> np.uint64(27)
    out *= np.uint64(0x94D049BB133111EB)
    out ^= out >> np.uint64(31)
    return out


def seeds(n: int, salt: int) -> np.ndarray:
    """n pseudo-random 64-bit numbers, the same ones on every machine."""
    return mix(mix(np.arange(1, n + 1, dtype=np.uint64)) + np.uint64(salt))


BYTE_VALUES = seeds(256, 11)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_LOWER_VALUES = BYTE_VALUES[_LOWER]
BLANK = np.zeros(256, dtype=bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True

_powers = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]


def _grown(n: int) -> list[np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, SLICE_BYTES)
        for k, base in enumerate((_ODD, _INVERSE)):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _powers[k] = np.multiply.accumulate(steps)
    return _powers


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One hash for each span of `values`; it depends on what the span holds, not on where it lies."""
    powers, inverse = _grown(len(values) + 1)
    sums = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * powers[: len(values)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts one after the other, and where each begins and the last ends. Null: empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return np.zeros(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    _, where, data = column.buffers()
    offsets = np.frombuffer(where, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    held = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, dtype=np.uint8)
    return held[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(sizes: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of neighbours whose sizes add up to at most `limit`, or one that is larger by itself."""
    began, held = 0, 0
    for k, size in enumerate(sizes):
        if k > began and held + size > limit:
            yield began, k
            began, held = k, 0
        held += size
    if began < len(sizes):
        yield began, len(sizes)


def word_spans(data: np.ndarray, offsets: np.ndarray, apart: np.ndarray = BLANK) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words (runs without bytes that are `apart`), and each text's first word's number."""
    none = np.zeros(0, dtype=np.int64)
    if not len(data):
        return none, none, np.zeros(len(offsets), dtype=np.int64)
    ink = ~apart[data]
    cut = np.zeros(len(data) + 1, dtype=bool)
    cut[offsets] = True
    before, after = np.ones(len(data), dtype=bool), np.ones(len(data), dtype=bool)
    before[1:] = ~ink[:-1]
    after[:-1] = ~ink[1:]
    starts = np.flatnonzero(ink & (before | cut[:-1]))
    ends = np.flatnonzero(ink & (after | cut[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, offsets: np.ndarray, apart: np.ndarray = BLANK) -> tuple[np.ndarray, np.ndarray]:
    """A hash for every word, with A-Z as a-z, and the number of each text's first word."""
    starts, ends, bounds = word_spans(data, offsets, apart)
    return span_hashes(_LOWER_VALUES[data], starts, ends), bounds


def shingles(words: np.ndarray, bounds: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct hashes of `width` neighbouring words, ascending within each text; and the texts' bounds.

    A text with fewer words has its whole sequence as one; a text without words has none.
    """
    counts = np.diff(bounds)
    held = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    edges = np.zeros(len(held) + 1, dtype=np.int64)
    np.cumsum(held, out=edges[1:])
    first = np.arange(edges[-1]) - np.repeat(edges[:-1], held) + np.repeat(bounds[:-1], held)
    span = np.repeat(np.minimum(counts, width), held)
    out = span.astype(np.uint64)
    for k in range(width):
        at = np.minimum(first + k, max(len(words) - 1, 0))
        out = np.where(k < span, out * _ODD + words[at], out) if len(words) else out
    out = mix(out)
    for a, b in zip(edges[:-1], edges[1:]):
        out[a:b].sort()
    fresh = np.ones(len(out), dtype=bool)
    fresh[1:] = out[1:] != out[:-1]
    fresh[edges[:-1][held > 0]] = True
    sums = np.zeros(len(out) + 1, dtype=np.int64)
    np.cumsum(fresh, out=sums[1:])
    return out[fresh], sums[edges]


def ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Positions start, start + 1, ... of every run, one run after the other."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - sizes), sizes)


def lists(values: np.ndarray, bounds: np.ndarray, kind: pa.DataType) -> pa.Array:
    """An Arrow list column over `values`, cut at `bounds`."""
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values, type=kind))


class HashTable:
    """Numbers 0, 1, ... for 64-bit keys, with open addressing; looked up for whole arrays."""

    def __init__(self, bits: int = 16):
        self.keys = np.zeros(1 << bits, dtype=np.uint64)  # 0 marks a free place
        self.numbers = np.zeros(1 << bits, dtype=np.int32)
        self.size = 0

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key, or -1."""
        keys = np.where(keys == 0, np.uint64(1), keys)
        mask = np.uint64(len(self.keys) - 1)
        out = np.full(len(keys), -1, dtype=np.int32)
        open_ = np.arange(len(keys))
        place = keys & mask
        while len(open_):
            there = self.keys[place]
            hit = there == keys[open_]
            out[open_[hit]] = self.numbers[place[hit]]
            on = ~hit & (there != 0)
            open_, place = open_[on], (place[on] + np.uint64(1)) & mask
        return out

    def add(self, keys: np.ndarray) -> None:
        """Number new, distinct keys in the order given."""
        keys = np.where(keys == 0, np.uint64(1), keys)
        if (self.size + len(keys)) * 2 > len(self.keys):
            old, numbers = self.keys, self.numbers
            bits = int(self.size + len(keys)).bit_length() + 2
            self.keys, self.numbers = np.zeros(1 << bits, dtype=np.uint64), np.zeros(1 << bits, dtype=np.int32)
            held = old != 0
            self._place(old[held], numbers[held])
        self._place(keys, np.arange(self.size, self.size + len(keys), dtype=np.int32))
        self.size += len(keys)

    def _place(self, keys: np.ndarray, numbers: np.ndarray) -> None:
        mask = np.uint64(len(self.keys) - 1)
        place = keys & mask
        while len(keys):
            free = np.flatnonzero(self.keys[place] == 0)
            _, first = np.unique(place[free], return_index=True)  # one key a place
            won = free[first]
            self.keys[place[won]], self.numbers[place[won]] = keys[won], numbers[won]
            left = np.ones(len(keys), dtype=bool)
            left[won] = False
            keys, numbers, place = keys[left], numbers[left], (place[left] + np.uint64(1)) & mask
