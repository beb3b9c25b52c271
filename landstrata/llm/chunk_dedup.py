"""Substring deduplication by content-defined chunks.

A gear rolling hash over the last 16 bytes decides at each word's start whether a chunk begins there,
so cuts depend on nearby text only and meet again soon after an insertion. Inside words longer than 64
bytes every character may begin a chunk, at a lower rate. So may every character of a script without
blanks, wherever it is, and two of them count as a word. From each
chunk on, the fewest chunks that span `min_words` words make a window. Equal windows are found by digest,
so they repeat as a whole; the first one in order of (document, position) is kept. Repeated windows of a
document that overlap or touch make a repeated passage.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from landstrata.llm.text import BLANK, BYTE_VALUES, seeds, slices, span_hashes, utf8
from landstrata.session import ship

WINDOW = 16  # bytes that the rolling hash looks back on
WORD_RATE = 2  # a chunk begins at one of 2**WORD_RATE words
INNER_RATE = 5  # and at one of 2**INNER_RATE characters far inside a word
INNER = 64  # bytes from the word's start on which count as far
DENSE_RATE = 3  # and at one of 2**DENSE_RATE characters of a script without blanks
MIN_WORDS = 12

_GEAR = seeds(256, 101).astype(np.uint32)

# First two bytes of characters of scripts without blanks: Thai, Lao and Tibetan, Myanmar and Khmer, kana and Han
# with their punctuation, and the planes of rarer Han characters.
_DENSE = np.zeros(1 << 16, dtype=bool)
for _a, _b in ((0xE0B8, 0xE0BF), (0xE180, 0xE182), (0xE19E, 0xE19F), (0xE380, 0xE9BF), (0xEFA4, 0xEFAB), (0xEFBD, 0xEFBE), (0xF0A0, 0xF0BF)):
    _DENSE[_a : _b + 1] = True


def repeated_spans(docs: DataFrame, min_words: int = MIN_WORDS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, start, end, words, kept_in): repeated passages, in bytes of the text's UTF-8, end exclusive.

    `kept_in` lists the documents that hold the kept first copies of the passage's windows, ascending.
    A document may repeat itself. A word that is longer than 64 bytes counts as one for every 64 bytes,
    and two characters of a script without blanks count as one word.
    Passages lie apart and ascend; each is made of stretches of `min_words` words or more that occur as
    they are in one document of `kept_in`. How much of a repeated passage is found: all but the words
    before its first cut and after its last, about ten.

    Null or empty texts have no chunks. Rows with a null key are left out. Repeated rows are one
    document. An empty table gives an empty result. Other columns are not looked at.
    """
    ship(docs.sparkSession)
    docs = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).alias("text")).where("doc_id is not null")
    windows = docs.mapInArrow(partial(_windows, min_words=min_words), "digest long, doc_id long, start int, size int, before int, words int, again boolean")

    # Counted per task before they are shuffled. The smallest document keeps its first copy.
    firsts = windows.groupBy("digest").agg(F.min("doc_id").alias("kept_in"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    copies = windows.join(firsts, "digest").where("doc_id <> kept_in or again")
    copies = copies.select("doc_id", "start", (F.col("start") + F.col("size")).alias("end"), "before", (F.col("before") + F.col("words")).alias("after"), "kept_in").repartition("doc_id")
    copies = copies.groupBy("doc_id", "start").agg(F.max("end").alias("end"), F.min("before").alias("before"), F.max("after").alias("after"), F.max("kept_in").alias("kept_in"))

    order = Window.partitionBy("doc_id").orderBy("start")
    reached = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    runs = copies.withColumn("apart", F.coalesce(F.col("start") > reached, F.lit(True)).cast("int"))
    runs = runs.withColumn("run", F.sum("apart").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    spans = runs.groupBy("doc_id", "run").agg(
        F.min("start").cast("bigint").alias("start"), F.max("end").cast("bigint").alias("end"),
        (F.max("after") - F.min("before")).cast("bigint").alias("words"), F.array_sort(F.collect_set("kept_in")).alias("kept_in"),
    )
    return spans.select(F.col("doc_id").alias(key), "start", "end", "words", "kept_in")


def without_repeats(docs: DataFrame, min_words: int = MIN_WORDS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`docs` with repeated passages cut out of `text`; all rows and columns stay, whatever their names.

    Rows without a repeated passage keep their text as it is, nulls included; so do rows with a null key.
    A row of a document that is repeated as a whole row is cut like the first one. What is left is joined
    without a filler. Texts may be of any length. An empty table gives an empty result.
    """
    spans = repeated_spans(docs, min_words, key, text)
    own = spans.groupBy(F.col(key).alias("doc_id")).agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("spans"))
    # Other columns travel in one, so that no name of theirs can clash.
    others = [c for c in docs.columns if c != text]
    given = docs.select(F.struct(*(F.col(f"`{c}`") for c in others)).alias("given"), F.col(key).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    found = given.join(own, "doc_id", "left")
    data = F.col("text").cast("binary")
    # The parts between the spans: from one span's end to the next one's start.
    starts = F.concat(F.array(F.lit(0).cast("bigint")), F.col("spans.end"))
    ends = F.concat(F.col("spans.start"), F.array(F.octet_length("text").cast("bigint")))
    held = F.zip_with(starts, ends, lambda a, b: F.substring(data, (a + 1).cast("int"), (b - a).cast("int")))
    left = F.aggregate(held, F.lit(b""), lambda out, part: F.concat(out, part)).cast("string")
    cut = F.when(F.col("spans").isNull(), F.col("text")).otherwise(left)
    return found.select(*(cut.alias(c) if c == text else F.col("given").getField(c).alias(c) for c in docs.columns))


# ---- inside a task -------------------------------------------------------------------------------


def dense(data: np.ndarray) -> np.ndarray:
    """Whether a character of a script without blanks begins at each byte."""
    out = np.zeros(len(data), dtype=bool)
    out[:-1] = _DENSE[(data[:-1].astype(np.uint16) << np.uint16(8)) | data[1:]]
    return out


def cuts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where chunks begin, ascending, and where words do. A text that is not empty begins with a chunk."""
    sizes = np.diff(offsets)
    # A window of zeros before each text, so that a text is not told by its neighbour.
    apart = offsets[:-1] + (np.arange(len(sizes)) + 1) * WINDOW
    padded = np.zeros(len(data) + len(sizes) * WINDOW, dtype=np.uint8)
    for a, b, to in zip(offsets[:-1].tolist(), offsets[1:].tolist(), apart.tolist()):
        padded[to : to + b - a] = data[a:b]
    gear = _GEAR[padded]
    width = 1
    while width < WINDOW:  # sums over 1, 2, 4, ... bytes, the newest byte unshifted
        older = gear[:-width] << np.uint32(width)
        gear[width:] += older
        width *= 2

    ink = ~BLANK[data]
    word = ink.copy()
    word[1:] &= ~ink[:-1]
    first = offsets[:-1][sizes > 0]
    word[first] = ink[first]
    words = np.flatnonzero(word)
    shift = apart - offsets[:-1]

    def before(at: np.ndarray) -> np.ndarray:  # the hash of the bytes before each place
        return gear[at + shift[np.searchsorted(offsets, at, side="right") - 1] - 1]

    begins = np.zeros(len(data), dtype=bool)
    begins[first] = True
    begins[words[before(words) >> np.uint32(32 - WORD_RATE) == 0]] = True
    word[first] = True
    edges = np.append(np.flatnonzero(word), len(data))
    for k in np.flatnonzero(np.diff(edges) > INNER).tolist():
        a, b = edges[k] + INNER, edges[k + 1]
        at = a + np.flatnonzero(((data[a:b] & 0xC0) != 0x80) & ink[a:b])
        begins[at[before(at) >> np.uint32(32 - INNER_RATE) == 0]] = True
    at = np.flatnonzero(dense(data))
    begins[at[before(at) >> np.uint32(32 - DENSE_RATE) == 0]] = True
    return np.flatnonzero(begins), words


def _windows(batches: Iterator[pa.RecordBatch], min_words: int) -> Iterator[pa.RecordBatch]:
    """Of every chunk, the window that begins with it: the fewest chunks of its text that span `min_words` words."""
    for batch in batches:
        everything, bounds = utf8(batch.column("text"))
        for a, b in slices(np.diff(bounds)):
            data, offsets = everything[bounds[a] : bounds[b]], bounds[a : b + 1] - bounds[a]
            if not len(data):
                continue
            starts, at = cuts(data, offsets)
            ends = np.append(starts[1:], len(data))
            own = np.searchsorted(offsets, starts, side="right") - 1
            # In parts of a word, so that chunks shorter than one add up: INNER a word, half as many a dense character.
            each = dense(data)
            parts = each * (INNER // 2)
            parts[at[~each[at]]] = INNER
            plain = np.append(0, np.cumsum(parts))
            held = np.maximum(plain[ends] - plain[starts], ends - starts)
            reached = np.cumsum(held)  # up to the end of each chunk
            before = reached - held
            last = np.searchsorted(reached, before + min_words * INNER)
            whole = np.flatnonzero(last < len(starts))
            whole = whole[own[last[whole]] == own[whole]]
            last = last[whole]
            starts, ends, words = starts[whole], ends[last], reached[last] - before[whole]
            before, own = before[whole] - before[np.searchsorted(own, own[whole])], own[whole]
            before, words = before // INNER, (before + words) // INNER - before // INNER
            digests = span_hashes(BYTE_VALUES[data], starts, ends)
            # Whether the same window is earlier in its text: by text and digest, then by place.
            order = np.lexsort((digests, own))
            again = np.zeros(len(digests), dtype=bool)
            again[order[1:]] = (digests[order[1:]] == digests[order[:-1]]) & (own[order[1:]] == own[order[:-1]])
            numbers = [pa.array(x.astype(np.int32)) for x in (starts - offsets[own], ends - starts, before, words)]
            yield pa.RecordBatch.from_arrays([pa.array(digests.view(np.int64)), batch.column("doc_id").take(pa.array(a + own)), *numbers, pa.array(again)], ["digest", "doc_id", "start", "size", "before", "words", "again"])
