"""Splitting whole batches of texts the way a tokenizer's pattern does, and coding each distinct span once.

The classes of characters (letter, number, white space, other) are asked of the tokenizer itself, once
for each character that occurs, so that they agree with its version of Unicode.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np

from landstrata.llm.text import HashTable, mix, ragged, slices, span_hashes

BLANK, LETTER, NUMBER, OTHER, UNSEEN = range(5)
PIECE = 200_000  # characters handled at once
# Spans a worker remembers before it begins anew; each takes some 60 bytes.
REMEMBERED = 1_000_000


class Classes:
    """Classes of code points by what `split(text)` makes of them beside a letter, a number and a mark."""

    def __init__(self, split: Callable[[str], list[str]]):
        self.split = split
        self.table = np.full(0x110000, UNSEEN, dtype=np.uint8)

    def of(self, points: np.ndarray) -> np.ndarray:
        out = self.table[points]
        if (out == UNSEEN).any():
            for c in np.unique(points[out == UNSEEN]).tolist():
                self.table[c] = self._ask(chr(c))
            out = self.table[points]
        return out

    def _ask(self, c: str) -> int:
        for kind, beside in ((LETTER, "a"), (NUMBER, "1"), (OTHER, "!")):
            if beside + c in self.split(beside + c) and len(self.split(beside + c)) == 1:
                return kind
        # A number that the pattern takes alone still does not join blanks.
        alone = [x.strip() for x in self.split("a" + c + "a")]
        return NUMBER if len(alone) == 3 and alone[1] else BLANK


def contractions(points: np.ndarray, kinds: np.ndarray, starts: np.ndarray, last: np.ndarray) -> None:
    """Moves the starts after 's 't 'm 'd 're 've 'll where a span begins with the apostrophe.

    `last`: whether a text ends with the character.
    """
    n = len(points)
    for i in np.flatnonzero((points == ord("'")) & starts & ~last).tolist():
        if kinds[i + 1] != LETTER:
            continue
        one = chr(points[i + 1])
        two = one + chr(points[i + 2]) if not last[i + 1] else ""
        size = 1 if one in "stmd" else 2 if two in ("re", "ve", "ll") else 0
        if size:
            starts[i + 1 : i + 1 + size] = False
            if i + 1 + size < n:
                starts[i + 1 + size] = True


def cut_long(text: str) -> Iterator[str]:
    """Pieces of a long text, cut before a single blank between two words, where every pattern here cuts."""
    while len(text) > PIECE:
        at = text.rfind(" ", 1, PIECE)
        while at > 0 and (text[at - 1].isspace() or text[at + 1].isspace()):
            at = text.rfind(" ", 1, at)
        if at <= 0:
            break
        yield text[:at]
        text = text[at:]
    yield text


def joined(texts: list[str]) -> Iterator[tuple[np.ndarray, str, np.ndarray, np.ndarray]]:
    """(text numbers, joined text, its code points, bounds) of about PIECE characters at a time."""
    pieces = [(k, piece) for k, text in enumerate(texts) for piece in cut_long(text)]
    sizes = np.array([len(p) for _, p in pieces], dtype=np.int64)
    for a, b in slices(sizes, PIECE):
        whole = "".join(p for _, p in pieces[a:b])
        points = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        yield np.array([k for k, _ in pieces[a:b]]), whole, points, np.concatenate([[0], np.cumsum(sizes[a:b])])


class SpanCoder:
    """Codes (arrays of numbers) of spans of text; `code` makes them for spans not met before.

    It returns for each kind of code the numbers of all spans in one row, and how many each span has.
    """

    def __init__(self, code: Callable[[list[str]], list[tuple]], kinds: tuple, remembered: int = REMEMBERED):
        self.code, self.kinds, self.remembered = code, kinds, remembered
        self._forget()

    def _forget(self) -> None:
        self.table = HashTable()
        self.pools = [np.zeros(1024, dtype=kind) for kind in self.kinds]
        self.bounds = [np.zeros(1025, dtype=np.int64) for _ in self.kinds]

    def numbers(self, whole: str, points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """A number for each span; valid until the next call."""
        keys = span_hashes(mix(points.astype(np.uint64) + np.uint64(77)), starts, ends)
        found = self.table.find(keys)
        missing = np.flatnonzero(found < 0)
        if not len(missing):
            return found
        fresh, first = np.unique(keys[missing], return_index=True)
        if self.table.size and self.table.size + len(fresh) > self.remembered:
            self._forget()
            return self.numbers(whole, points, starts, ends)
        at = missing[first]
        coded = self.code([whole[a:b] for a, b in zip(starts[at].tolist(), ends[at].tolist())])
        for k, (flat, sizes) in enumerate(coded):
            self._append(k, np.asarray(flat, dtype=self.kinds[k]), sizes)
        self.table.add(fresh)
        found[missing] = self.table.find(keys[missing])
        return found

    def _append(self, k: int, flat: np.ndarray, sizes: list[int]) -> None:
        size, more = self.table.size, len(sizes)
        while size + more >= len(self.bounds[k]):
            self.bounds[k] = np.concatenate([self.bounds[k], np.zeros_like(self.bounds[k])])
        held = self.bounds[k][size]
        while held + len(flat) > len(self.pools[k]):
            self.pools[k] = np.concatenate([self.pools[k], np.zeros_like(self.pools[k])])
        self.pools[k][held : held + len(flat)] = flat
        self.bounds[k][size + 1 : size + 1 + more] = held + np.cumsum(sizes)

    def codes(self, k: int, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The k-th codes of the numbered spans one after the other, and how many each has."""
        starts = self.bounds[k][numbers]
        sizes = self.bounds[k][numbers + 1] - starts
        return self.pools[k][ragged(starts, sizes)], sizes
