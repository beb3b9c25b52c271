"""BPE encoding with a priority queue of merges over a linked list of symbols, and decoding.

The tokenizer's file names its vocabulary, merges, special tokens and normalisation; they are read on
the workers. Texts are split for whole batches at a time and each distinct word is merged once while a
worker remembers it. A special token's text inside a document stands for that token, as in the library
with its default settings.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landstrata.llm.pretoken import BLANK, NUMBER, Classes, SpanCoder, contractions, joined
from landstrata.session import ship


def encode_digests(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_tokens, ids_sha256, decoded_sha256) of every row's text; `tokenizer` is the file's path.

    Null texts count as empty: no tokens, and the digests of nothing. Repeated rows are returned as
    often, and null keys are kept. Texts may be of any length; an empty table gives an empty result. Other
    columns are not looked at. Rows are independent of each other.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    kind = docs.schema[key].dataType.simpleString()
    out = rows.mapInArrow(partial(_digests, tokenizer=tokenizer), f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
    return out.withColumnRenamed("doc_id", key)


def encode(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ids): the token ids of every row's text, as `encode_digests` counts them."""
    ship(docs.sparkSession)
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    kind = docs.schema[key].dataType.simpleString()
    return rows.mapInArrow(partial(_ids, tokenizer=tokenizer), f"doc_id {kind}, ids array<int>").withColumnRenamed("doc_id", key)


def decode(rows: DataFrame, tokenizer: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """(key, text): vocabulary strings of the ids, one blank between two; a null list gives null."""
    ship(rows.sparkSession)
    kind = rows.schema[key].dataType.simpleString()
    given = rows.select(F.col(key).alias("doc_id"), F.col(ids).alias("ids"))
    return given.mapInArrow(partial(_texts, tokenizer=tokenizer), f"doc_id {kind}, text string").withColumnRenamed("doc_id", key)


# ---- inside a task -------------------------------------------------------------------------------


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return [chr(b) if b in plain else chr(256 + rest.index(b)) for b in range(256)]


class Vocabulary:
    """One tokenizer file: symbols, merges and the words met so far."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.ids: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.suffix = model["end_of_word_suffix"] or ""
        self.symbols = byte_symbols()
        self.width = max(*self.ids.values(), *self.special.values()) + 1
        self.strings = [""] * self.width
        for token, k in {**self.ids, **self.special}.items():
            self.strings[k] = token
        self.coded = [s.encode() + b" " for s in self.strings]
        self.merges: dict[int, tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.merges[self.ids[a] * self.width + self.ids[b]] = (rank, self.ids[a + b])
        split = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
        self.classes = Classes(lambda text: _unbyted(split(text)))
        self.words = SpanCoder(self._code, (np.uint32, np.uint8))
        self.cut = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None

    def merge(self, word: str) -> list[int]:
        """Symbols of a word merged by rank, the leftmost first among equals."""
        symbols = [self.symbols[b] for b in word.encode("utf-8", "surrogatepass")]
        symbols[-1] += self.suffix
        ids = [self.ids[s] for s in symbols]
        after, before = [*range(1, len(ids)), -1], [*range(-1, len(ids) - 1)]
        merges, width = self.merges, self.width
        queue = []
        for i in range(len(ids) - 1):
            found = merges.get(pair := ids[i] * width + ids[i + 1])
            if found:
                queue.append((found[0], i, pair, found[1]))
        heapq.heapify(queue)
        while queue:
            _, i, pair, new = heapq.heappop(queue)
            j = after[i]
            if j < 0 or ids[i] * width + ids[j] != pair:
                continue  # stale: one of the two symbols has been merged since
            ids[i], ids[j] = new, -width  # a used symbol makes no pair that is in the queue
            after[i] = k = after[j]
            if k >= 0:
                before[k] = i
                if found := merges.get(pair := new * width + ids[k]):
                    heapq.heappush(queue, (found[0], i, pair, found[1]))
            h = before[i]
            if h >= 0 and (found := merges.get(pair := ids[h] * width + new)):
                heapq.heappush(queue, (found[0], h, pair, found[1]))
        return [k for k in ids if k >= 0]

    def _code(self, words: list[str]) -> list[tuple]:
        merged = [self.merge(word) for word in words]
        flat = [k for ids in merged for k in ids]
        text = [b"".join([self.coded[k] for k in ids]) for ids in merged]
        return [(flat, [len(ids) for ids in merged]), (np.frombuffer(b"".join(text), dtype=np.uint8), [len(t) for t in text])]

    def normal(self, text: str) -> str:
        """Composed and in lower case, each character by itself; kinds of white space do not matter here."""
        if not text.isascii():
            text = unicodedata.normalize("NFC", text)
            if "Σ" in text:  # by itself it has one lower case, wherever it stands
                text = text.replace("Σ", "σ")
        return text.lower()

    def spans(self, points: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Runs of letters, single numbers, runs of other marks, and contractions."""
        kinds = self.classes.of(points)
        starts = np.ones(len(points), dtype=bool)
        starts[1:] = (kinds[1:] != kinds[:-1]) | (kinds[1:] == NUMBER)
        starts[bounds[:-1][np.diff(bounds) > 0]] = True
        last = np.zeros(len(points), dtype=bool)
        last[bounds[1:][np.diff(bounds) > 0] - 1] = True
        contractions(points, kinds, starts, last)
        at = np.flatnonzero(starts)
        ends = np.append(at[1:], len(points))
        kept = kinds[at] != BLANK
        return at[kept], ends[kept]

    def encoded(self, texts: list[str]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(number of the text, ids, decoded bytes with a blank after each token), piece by piece."""
        parts: list[tuple[int, str]] = []
        for k, text in enumerate(texts):
            cut = self.cut.split(text) if self.cut and "<" in text else [text]
            parts += [(k, part) for part in cut]
        plain = [self.normal(part) if part not in self.special else "" for _, part in parts]
        for numbers, whole, points, bounds in joined(plain):
            starts, ends = self.spans(points, bounds)
            spans = self.words.numbers(whole, points, starts, ends) if len(starts) else np.zeros(0, dtype=np.int32)
            cuts = np.searchsorted(starts, bounds)
            ids, sizes = self.words.codes(0, spans)
            text, lengths = self.words.codes(1, spans)
            a = np.concatenate([[0], np.cumsum(sizes)])[cuts]
            b = np.concatenate([[0], np.cumsum(lengths)])[cuts]
            for x, number in enumerate(numbers.tolist()):
                k, part = parts[number]
                if part in self.special:
                    yield k, np.array([self.special[part]], dtype=np.uint32), np.frombuffer(part.encode() + b" ", dtype=np.uint8)
                else:
                    yield k, ids[a[x] : a[x + 1]], text[b[x] : b[x + 1]]


def _unbyted(pieces: list[tuple]) -> list[str]:
    """Byte-level pieces as text again."""
    back = {s: b for b, s in enumerate(byte_symbols())}
    return [bytes(back[c] for c in piece).decode("utf-8", "replace") for piece, _ in pieces]


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def _digests(batches: Iterator[pa.RecordBatch], tokenizer: str) -> Iterator[pa.RecordBatch]:
    known = vocabulary(tokenizer)
    for batch in batches:
        n = batch.num_rows
        counts, ids, text = np.zeros(n, dtype=np.int64), [hashlib.sha256() for _ in range(n)], [hashlib.sha256() for _ in range(n)]
        open_ = [b""] * n  # the blank after a token is said only when another one follows
        for k, own, decoded in known.encoded([t or "" for t in batch.column("text").to_pylist()]):
            if len(own):
                counts[k] += len(own)
                ids[k].update(own.tobytes())
                text[k].update(open_[k] + decoded[:-1].tobytes())
                open_[k] = b" "
        columns = [batch.column("doc_id"), pa.array(counts), pa.array([x.hexdigest() for x in ids]), pa.array([x.hexdigest() for x in text])]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])


def _ids(batches: Iterator[pa.RecordBatch], tokenizer: str) -> Iterator[pa.RecordBatch]:
    known = vocabulary(tokenizer)
    for batch in batches:
        out: list[list[np.ndarray]] = [[] for _ in range(batch.num_rows)]
        for k, own, _ in known.encoded([t or "" for t in batch.column("text").to_pylist()]):
            out[k].append(own)
        rows = [np.concatenate(x).astype(np.int32) if x else np.zeros(0, dtype=np.int32) for x in out]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(rows, pa.list_(pa.int32()))], ["doc_id", "ids"])


def _texts(batches: Iterator[pa.RecordBatch], tokenizer: str) -> Iterator[pa.RecordBatch]:
    known = vocabulary(tokenizer)
    for batch in batches:
        texts = [None if row is None else " ".join(known.strings[k] for k in row) for row in batch.column("ids").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])
