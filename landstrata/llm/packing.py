"""Best-fit packing of token sequences by exact complements.

How pieces are packed depends only on how many there are of each length, and a length is at most the
capacity: the plan is made from that table of at most `capacity` rows, whatever the number of
documents. Every length's gap is filled exactly by a single, a pair or a triple of other lengths, as
many times over as their counts allow; what finds no exact filling is placed best-fit, longest first.
The plan says, for ranges of ranks of a length, in which sequences they lie. Tasks rank their own pieces
and learn from the counts of the tasks before them where their ranks begin.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from landstrata.llm.pretoken import BLANK, Classes, SpanCoder, contractions, joined
from landstrata.session import materialise, ship


def pack(docs: DataFrame, tokenizer: str, end: int = 2, capacity: int = 1024, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, piece, start, length, ids_crc32, sequence_id, offset): every document's pieces and their places.

    A document is its tokens and then `end`. If it is longer than `capacity` it is cut into pieces of
    `capacity` tokens, of which the first may be shorter. `start` counts the document's tokens before
    the piece, `offset` the sequence's. Sequences are numbered from 0 and filled without gaps.

    Null texts count as empty and hold `end` only. Rows are independent: repeated rows and null keys
    are packed like any others. An empty table gives an empty result. Other columns are not looked at.
    """
    spark = ship(docs.sparkSession)
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    kind = docs.schema[key].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length int, ids_crc32 long, task int, rank long"
    pieces = materialise(rows.mapInArrow(partial(_pieces, tokenizer=tokenizer, end=end, capacity=capacity), schema))

    counts = pieces.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    counts = materialise(counts.select("length", "task", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")))
    totals = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most `capacity` rows
    plan = spark.sparkContext.broadcast(places(arrangement(totals, capacity)))

    ranked = pieces.join(counts.select("length", "task", "base"), ["length", "task"])
    ranked = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("base") + F.col("rank")).alias("rank"))
    out = ranked.mapInArrow(partial(_placed, plan=plan), f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
    return out.withColumnRenamed("doc_id", key)


def arrangement(counts: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of one sequence, number of such sequences), using every piece once.

    Exact fillings may spend short pieces that best-fit needs for the gaps of long ones, so plans are made
    with fillings of up to three, two, one and no other pieces, and the one of fewest sequences is taken.
    The last is best-fit decreasing by itself, which a plan therefore never exceeds.
    """
    plans = (_arrangement(counts, capacity, most) for most in (3, 2, 1, 0))
    return min(plans, key=lambda plan: sum(copies for _, copies in plan))


def _arrangement(counts: dict[int, int], capacity: int, most: int) -> list[tuple[tuple[int, ...], int]]:
    """Exact fillings of every length's gap by up to `most` pieces, then best-fit of what is left."""
    left = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in counts.items():
        left[length] += n
    out: list[tuple[tuple[int, ...], int]] = []
    pairs = _Pairs(capacity)

    def take(lengths: tuple[int, ...]) -> bool:
        copies = min(int(left[x]) // lengths.count(x) for x in lengths)
        if copies:
            for x in lengths:
                left[x] -= copies
            out.append((lengths, copies))
        return copies > 0

    for length in range(capacity, 0, -1):
        gap = capacity - length
        while left[length]:
            if not gap:
                take((length,))
                continue
            single = most >= 1 and left[gap] and take((length, gap))
            if not (single or (most >= 2 and _pair(left, length, gap, take)) or (most >= 3 and _triple(left, length, gap, pairs, take))):
                break
    return out + _best_fit({x: int(left[x]) for x in np.flatnonzero(left).tolist()}, capacity)


class _Pairs:
    """The lengths that two available pieces add up to."""

    def __init__(self, capacity: int):
        self.capacity, self.seen, self.sums = capacity, None, None

    def of(self, left: np.ndarray) -> np.ndarray:
        held = left > 0
        if self.seen is None or (held != self.seen).any():
            self.seen = held
            self.sums = np.convolve(held, held.astype(np.int64))[: self.capacity + 1] > 0
        return self.sums


def _pair(left: np.ndarray, length: int, gap: int, take) -> bool:
    """Fills the gap exactly with two pieces, the longer one as long as can be."""
    longer = np.arange(gap - 1, (gap + 1) // 2 - 1, -1)
    for a in longer[(left[longer] > 0) & (left[gap - longer] > 0)].tolist():
        if take((length, a, gap - a)):
            return True
    return False


def _triple(left: np.ndarray, length: int, gap: int, pairs: _Pairs, take) -> bool:
    """Fills the gap exactly with three pieces, the longest one as long as can be."""
    sums = pairs.of(left)
    first = np.arange(gap - 2, 0, -1)
    for a in first[(left[first] > 0) & sums[gap - first]].tolist():
        rest = gap - a
        for b in range(min(a, rest - 1), (rest + 1) // 2 - 1, -1):
            if left[b] and left[rest - b] and take((length, a, b, rest - b)):
                return True
    return False


def _best_fit(left: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Longest first into the smallest gap that holds it; equal sequences are handled together."""
    gaps: dict[int, dict[tuple[int, ...], int]] = {}

    def put(lengths: tuple[int, ...], copies: int) -> None:
        group = gaps.setdefault(capacity - sum(lengths), {})
        group[lengths] = group.get(lengths, 0) + copies

    for length in sorted(left, reverse=True):
        n = left[length]
        while n:
            gap = min((g for g, group in gaps.items() if g >= length and group), default=None)
            lengths, copies = gaps[gap].popitem() if gap is not None else ((), n)
            fit = (capacity if gap is None else gap) // length
            full = min(copies, n // fit)
            if full:
                put(lengths + (length,) * fit, full)
                copies, n = copies - full, n - full * fit
            if n and copies and n < fit:
                put(lengths + (length,) * n, 1)
                copies, n = copies - 1, 0
            if copies and lengths:
                put(lengths, copies)
    return [(lengths, copies) for group in gaps.values() for lengths, copies in group.items()]


def places(arranged: list[tuple[tuple[int, ...], int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ranges of ranks: where each begins (length and first rank in one number), the sequence number of
    rank 0 if the range went on, and the offset."""
    rows, used, first = [], {}, 0
    for lengths, copies in arranged:
        offset = 0
        for length in lengths:
            rank = used.get(length, 0)
            rows.append(((length << 48) + rank, first - rank, offset))
            used[length] = rank + copies
            offset += length
        first += copies
    table = np.array(sorted(rows), dtype=np.int64).reshape(-1, 3)
    return table[:, 0], table[:, 1], table[:, 2]


# ---- inside a task -------------------------------------------------------------------------------


def _placed(batches: Iterator[pa.RecordBatch], plan: Broadcast) -> Iterator[pa.RecordBatch]:
    keys, sequences, offsets = plan.value
    for batch in batches:
        length, rank = batch.column("length").to_numpy().astype(np.int64), batch.column("rank").to_numpy()
        at = np.searchsorted(keys, (length << 48) + rank, side="right") - 1
        columns = [*(batch.column(c) for c in ("doc_id", "piece", "start")), pa.array(length), batch.column("ids_crc32"), pa.array(sequences[at] + rank), pa.array(offsets[at])]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])


class ByteBpe:
    """A byte-level tokenizer of the library; spans of its pattern are encoded once while remembered."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        split = self.tokenizer.pre_tokenizer.pre_tokenize_str
        self.classes = Classes(lambda text: _at(text, split(text)))
        self.spans = SpanCoder(self._code, (np.uint32,))

    def _code(self, spans: list[str]) -> list[tuple]:
        ids = [e.ids for e in self.tokenizer.encode_batch_fast(spans, add_special_tokens=False)]
        return [([k for own in ids for k in own], [len(own) for own in ids])]

    def starts(self, points: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Where the pattern cuts: runs of one class, with a blank before them; white space by itself
        but for its last character; contractions."""
        kinds = self.classes.of(points)
        space = points == 0x20
        edge = np.zeros(len(points) + 1, dtype=bool)
        edge[bounds] = True
        blank = kinds == BLANK
        starts = edge[:-1].copy()
        starts[1:] |= ~blank[1:] & (kinds[1:] != kinds[:-1]) & ~space[:-1]
        starts[1:] |= blank[1:] & ~blank[:-1]
        starts[:-1] |= blank[:-1] & ~blank[1:] & ~edge[1:-1]
        contractions(points, kinds, starts, edge[1:])
        return np.flatnonzero(starts)

    def encoded(self, texts: list[str]) -> Iterator[tuple[int, np.ndarray]]:
        """(number of the text, ids), in the order of the texts; a long text in several parts."""
        for numbers, whole, points, bounds in joined(["" if self._plain(t) is None else t for t in texts]):
            starts = self.starts(points, bounds)
            ends = np.append(starts[1:], len(points))
            spans = self.spans.numbers(whole, points, starts, ends) if len(starts) else np.zeros(0, dtype=np.int32)
            ids, sizes = self.spans.codes(0, spans)
            cuts = np.concatenate([[0], np.cumsum(sizes)])[np.searchsorted(starts, bounds)]
            for k, a, b in zip(numbers.tolist(), cuts[:-1], cuts[1:]):
                if self._plain(texts[k]) is None:
                    yield k, np.array(self.tokenizer.encode(texts[k], add_special_tokens=False).ids, dtype=np.uint32)
                else:
                    yield k, ids[a:b]

    def _plain(self, text: str) -> str | None:
        """The text, or None if it holds a special token's text, which the library must see whole."""
        return None if any(s in text for s in self.special) else text


def _at(text: str, pieces: list[tuple]) -> list[str]:
    return [text[a:b] for _, (a, b) in pieces]


@lru_cache(maxsize=2)
def byte_bpe(path: str) -> ByteBpe:
    return ByteBpe(path)


def _pieces(batches: Iterator[pa.RecordBatch], tokenizer: str, end: int, capacity: int) -> Iterator[pa.RecordBatch]:
    known, task = byte_bpe(tokenizer), TaskContext.get().partitionId()
    ranks = [0] * (capacity + 1)
    for batch in batches:
        rows: list[tuple] = []

        def close(k: int, parts: list[np.ndarray]) -> None:
            ids = np.concatenate([*parts, np.array([end], dtype=np.uint32)])
            cuts = [0, *range(len(ids) % capacity or capacity, len(ids) + 1, capacity)]
            for piece, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
                rows.append((k, piece, a, b - a, zlib.crc32(ids[a:b].astype("<u4").tobytes()), ranks[b - a]))
                ranks[b - a] += 1

        now, parts = 0, []
        for k, ids in known.encoded([t or "" for t in batch.column("text").to_pylist()]):
            if k != now:
                close(now, parts)
                now, parts = k, []
            parts.append(ids)
        if batch.num_rows:
            close(now, parts)
        if rows:
            k, piece, start, length, crc, rank = zip(*rows)
            own = [batch.column("doc_id").take(pa.array(k)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int32()), pa.array(crc, pa.int64())]
            yield pa.RecordBatch.from_arrays([*own, pa.array([task] * len(rows), pa.int32()), pa.array(rank, pa.int64())], ["doc_id", "piece", "start", "length", "ids_crc32", "task", "rank"])
