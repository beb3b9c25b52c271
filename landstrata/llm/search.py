"""Exact top-k search with BM25: an inverted index per shard, block-max WAND, one merge.

Statistics (documents, their mean length, document frequencies) are counted over all rows first, so a
score does not depend on the shard. The index is built once and stored: each task writes chunks of
postings, with places in the order of the keys. Chunks are dealt out to shards, and every block of
queries is sent to every shard; nothing passes through the driver. A shard's best k of a query, merged
with those of the other shards, hold the best k of all.

Within a chunk, places are cut into spans. A term's postings of one span are a block with the largest
impact as its maximum. For a query the maxima of each span's blocks, weighed and summed, bound the
score of any place there. Spans are scored from the largest bound on until the next bound cannot beat
the k-th best score so far, which a query takes along from chunk to chunk; postings of spans beyond
that are never read. It is WAND's test, made for whole spans at a time, so that a query may have any
number of terms, such as all of a long text. Where the test leaves more than half of a chunk, its
lists are read whole, as that is faster than picking spans out of them.

Queries of many terms, such as whole texts, meet most places, and there a posting at a time is too
slow. A block of such queries is answered by whole units of chunks (`Unit`): terms that many of a
unit's documents hold are columns of a matrix, the others stay lists. For all queries of a block at
once the lists are summed, the columns' maxima bound each span, and a matrix product scores the spans
that may hold one of the best k. These scores are rounded to 32 bits; they only choose, with a margin
for all that rounding may do, the rows whose exact scores are then summed as above.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from functools import partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from landstrata.llm.blobs import packed, packed_sorted, size_of, unpacked, unpacked_sorted
from landstrata.llm.text import SLICE_BYTES, mix, ragged, slices, utf8, word_hashes
from landstrata.session import materialise, ship
from landstrata.sources.files import release_memory

K1, B = 1.2, 0.75
TERMS = 3_000_000  # terms of the queries of one block, on average; a query is never split
CHUNK = 1_000_000  # a chunk is closed when it holds as many postings
SHARD = 32_000_000  # postings of a shard on average; some 2 bytes each are held by its task
SHARDS = 16  # shards of a small index
SPAN = 256  # places under one block maximum
FIRST = 2  # spans scored before the first look at the k-th best; each later step takes twice as many
MANY = 64  # terms a query, on average, from which a block of queries is answered by matrices
UNIT = 2_500_000  # postings of the chunks that such a block meets at once
DENSE = 24  # a term that one document and one query in so many hold is a column of a unit's matrix
COLUMNS = 24_000_000  # cells of a unit's matrix; beyond, terms stay lists
CELLS = 4_000_000  # scores of queries and places that are held at once
RESCORED = 500_000  # postings that are summed exactly at once
COPIES = 64  # rows to be summed exactly from which equal ones are looked for
SORTED_BY = 16  # the most common columns, by which places of a unit are ordered

# Terms are runs of ASCII letters and digits and of bytes beyond ASCII, with A-Z as a-z.
APART = np.array([c < 128 and not chr(c).isalnum() for c in range(256)])


def statistics(docs: DataFrame, text: str = "text") -> tuple[DataFrame, int, float]:
    """(term, df) in shared storage, the number of documents and their mean length in terms.

    Null texts are documents without terms.
    """
    ship(docs.sparkSession)
    counted = docs.select(F.col(text).alias("text")).mapInArrow(_frequencies, "term long, df long, docs long, terms long")
    table = counted.groupBy("term").agg(F.sum("df").alias("df"), F.sum("docs").alias("docs"), F.sum("terms").alias("terms"))
    table = materialise(table)
    whole = table.where("term is null").first()
    n, terms = (whole.docs, whole.terms) if whole else (0, 0)
    return table.where("term is not null").select("term", "df"), n, terms / n if n and terms else 1.0


def telling_terms(queries: DataFrame, df: DataFrame, n: int, terms: int | None = 16, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(query_id, term, weight): a text's `terms` terms of the largest weight, tf * idf; ties by term.

    The whole text is read. A text with fewer distinct terms asks for all of them, and so does any with None.
    """
    rows = queries.select(F.col(key).cast("bigint").alias("query_id"), F.col(text).alias("text")).where("query_id is not null")
    asked = rows.mapInArrow(_query_terms, "query_id long, term long, tf long").distinct().join(df, "term")
    idf = F.log(1 + (F.lit(float(n)) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weighed = asked.select("query_id", "term", (F.col("tf") * idf).alias("weight"))
    if terms is None:
        return weighed
    order = Window.partitionBy("query_id").orderBy(F.desc("weight"), "term")
    return weighed.withColumn("place", F.row_number().over(order)).where(F.col("place") <= terms).drop("place")


def search(docs: DataFrame, asked: DataFrame, mean: float, k: int = 10, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(query_id, rank, key, score): for every query of `asked(query_id, term, weight)` its best k rows.

    A row's score is the sum over the query's terms of weight * tf * (K1 + 1) / (tf + K1 * (1 - B + B *
    length / mean)). Ranks go by score, then by the smaller key. Rows without a term of the query are not
    returned. Null texts match nothing, rows with a null key are left out, and a repeated row is found
    as often as it is there. A text of any length is one row of its chunk. Without rows or queries the
    result is empty. Other columns are not looked at.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).alias("text")).where("doc_id is not null")
    index = materialise(rows.mapInArrow(_indexed, "postings long, " + ", ".join(f"{c} binary" for c in CHUNK_COLUMNS)))
    postings = index.agg(F.sum("postings")).first()[0] or 0
    shards = max(SHARDS, -(-postings // SHARD))

    asked = materialise(asked.select("query_id", "term", "weight"))
    blocks = max(1, -(-asked.count() // TERMS))
    block = F.pmod(F.xxhash64("query_id"), F.lit(blocks)).alias("at")
    given = asked.select(block, "query_id", "term", "weight").repartition("at").sortWithinPartitions("at", "query_id", "term")
    given = given.mapInArrow(_blocks, "at long, " + ", ".join(f"{c} binary" for c in BLOCK_COLUMNS))

    # A shard's chunks come first and stay; blocks of queries follow one by one.
    none = [F.lit(None).cast("binary")] * (len(CHUNK_COLUMNS) - len(BLOCK_COLUMNS))
    names = [f"blob{k}" for k in range(len(CHUNK_COLUMNS))]
    number = F.monotonically_increasing_id()  # the writing task, and the chunk's place in it
    shard = F.pmod(F.shiftright(number, 33) + number.bitwiseAND(F.lit((1 << 33) - 1)), F.lit(shards)).alias("shard")
    chunks = index.select(shard, F.lit(-1).cast("bigint").alias("at"), *CHUNK_COLUMNS)
    every = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(shards - 1).cast("bigint"))).alias("shard")
    met = chunks.toDF("shard", "at", *names).unionByName(given.select(every, "at", *BLOCK_COLUMNS, *none).toDF("shard", "at", *names))
    met = met.repartitionById(shards, F.col("shard").cast("int")).sortWithinPartitions("shard", "at")  # a task for each
    found = met.mapInArrow(partial(_searched, mean=mean, k=k), "query_id long, doc_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "doc_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.col("doc_id").alias(key), "score")


CHUNK_COLUMNS = ["terms", "sizes", "places", "tfs", "ids", "lengths", "marks"]
BLOCK_COLUMNS = ["queries", "bounds", "asked", "numbers", "values", "weights"]


# ---- inside a task -------------------------------------------------------------------------------


def _terms(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, terms, bounds of the rows) of slices of a column of texts."""
    data, offsets = utf8(column)
    for a, b in slices(np.diff(offsets), SLICE_BYTES):
        yield a, *word_hashes(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], APART)


def _counted(terms: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, term, tf) of the distinct terms of each row, by row and term."""
    terms = terms.view(np.int64).copy()
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        terms[a:b].sort()
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    fresh = np.ones(len(terms), dtype=bool)
    fresh[1:] = (terms[1:] != terms[:-1]) | (row[1:] != row[:-1])
    at = np.flatnonzero(fresh)
    return row[at], terms[at], np.diff(np.append(at, len(terms)))


def _marks(row: np.ndarray, term: np.ndarray, tf: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """A hash of each row's terms, their counts and its length."""
    sums = np.zeros(len(row) + 1, dtype=np.uint64)
    np.cumsum(mix(mix(term.view(np.uint64)) + tf.astype(np.uint64)), out=sums[1:])
    edges = np.searchsorted(row, np.arange(len(lengths) + 1))
    return mix(sums[edges[1:]] - sums[edges[:-1]] + mix(lengths.astype(np.uint64)))


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Document frequencies of some thousand rows at a time, and one row for the number of rows."""
    docs = total = 0
    kept: list[np.ndarray] = []
    held = 0

    def flush() -> pa.RecordBatch:
        terms, df = np.unique(np.concatenate(kept), return_counts=True)
        kept.clear()
        none = pa.nulls(len(terms), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(terms), pa.array(df), none, none], ["term", "df", "docs", "terms"])

    for batch in batches:
        docs += batch.num_rows
        for _, terms, bounds in _terms(batch.column("text")):
            total += len(terms)
            kept.append(_counted(terms, bounds)[1])
            held += len(kept[-1])
            if held > CHUNK:
                yield flush()
                held = 0
    if kept:
        yield flush()
    yield pa.RecordBatch.from_pydict({"term": pa.nulls(1, pa.int64()), "df": pa.nulls(1, pa.int64()), "docs": [docs], "terms": [total]})


def _query_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, terms, bounds in _terms(batch.column("text")):
            row, term, tf = _counted(terms, bounds)
            yield pa.RecordBatch.from_arrays([batch.column("query_id").take(pa.array(first + row)), pa.array(term), pa.array(tf)], ["query_id", "term", "tf"])


def _table(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = [pa.int64()] + [pa.binary()] * (len(names) - 1)
    return pa.RecordBatch.from_arrays([pa.array(list(c), type=t) for c, t in zip(zip(*rows), kinds)], names)


def _indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks: (number of postings, sorted terms, their numbers of postings, places and counts by term,
    keys, lengths and marks by place). Texts of the same terms, as often, and of one length have one mark."""
    ids, lengths, marks, parts, docs, held = [], [], [], [], 0, 0

    def chunk() -> pa.RecordBatch:
        keys, size = np.concatenate(ids), np.concatenate(lengths)
        order = np.argsort(keys, kind="stable")  # places ascend with the keys, for ties
        place_of = np.empty(len(keys), dtype=np.int64)
        place_of[order] = np.arange(len(keys))
        row, term, tf = (np.concatenate(x) for x in zip(*parts))
        parts.clear()  # a task holds one copy of a chunk
        place = place_of[row]
        del row
        by = np.lexsort((place, term))
        term, place, tf = term[by], place[by], tf[by]
        starts = np.flatnonzero(np.diff(term, prepend=term[0] - 1 if len(term) else 0)) if len(term) else np.zeros(0, dtype=np.int64)
        sizes = np.diff(np.append(starts, len(term)))
        steps = np.diff(place, prepend=0)
        steps[starts] = place[starts]
        blobs = (packed_sorted(term[starts].view(np.uint64) + SHIFT), packed(sizes.astype(np.uint32)), packed(steps.astype(np.uint32)), packed(tf.astype(np.uint32)))
        return _table([(len(term), *blobs, packed(keys[order]), packed(size[order].astype(np.uint32)), packed(np.concatenate(marks)[order]))], ["postings", *CHUNK_COLUMNS])

    for batch in batches:
        keys = batch.column("doc_id").to_numpy()
        for first, terms, bounds in _terms(batch.column("text")):
            row, term, tf = _counted(terms, bounds)
            parts.append(((row + docs).astype(np.int32), term, tf.astype(np.int32)))
            ids.append(keys[first : first + len(bounds) - 1])
            lengths.append(np.diff(bounds))
            marks.append(_marks(row, term, tf, lengths[-1]))
            docs += len(bounds) - 1
            held += len(row)
            if held > CHUNK:
                yield chunk()
                ids, lengths, marks, parts, docs, held = [], [], [], [], 0, 0
    if held:
        yield chunk()


# Terms are signed numbers; as unsigned ones of the same order they can be packed by their differences.
SHIFT = np.uint64(1 << 63)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by (at, query_id): a row for each run of whole queries of one block, which is cut
    only where it is twice as long as the average, as a shard unpacks its chunks anew for each run."""
    held: list[list[np.ndarray]] = []
    rows, last = 0, None
    for batch in batches:
        now = np.stack([batch.column(c).to_numpy() for c in ("at", "query_id")])
        rest = [batch.column(c).to_numpy() for c in ("query_id", "term", "weight")]
        fresh = now != np.concatenate([now[:, :1] if last is None else last, now[:, :-1]], axis=1)
        done = 0
        for cut in np.flatnonzero(fresh[1]).tolist():
            if fresh[0, cut] or rows + cut - done >= 2 * TERMS:
                held.append([x[done:cut] for x in rest])
                yield _run(int(last[0, 0] if cut == 0 else now[0, cut - 1]), *(np.concatenate(x) for x in zip(*held)))
                held, rows, done = [], 0, cut
        held.append([x[done:] for x in rest])
        rows, last = rows + len(rest[0]) - done, now[:, -1:]
    if rows:
        yield _run(int(last[0, 0]), *(np.concatenate(x) for x in zip(*held)))


def _run(at: int, query: np.ndarray, term: np.ndarray, weight: np.ndarray) -> pa.RecordBatch:
    ids, starts = np.unique(query, return_index=True)
    asked, number = np.unique(term, return_inverse=True)
    values, which = np.unique(weight, return_inverse=True)
    blobs = (packed(ids), packed(np.append(starts, len(query))), packed_sorted(asked.view(np.uint64) + SHIFT))
    return _table([(at, *blobs, packed(number.astype(np.uint32)), packed(values), packed(which.astype(np.uint32)))], ["at", *BLOCK_COLUMNS])


class Chunk:
    """Postings by term, and the blocks that spans of places cut them into."""

    def __init__(self, blobs: list[bytes], mean: float):
        terms, sizes, places, tfs, ids, lengths, _ = blobs
        self.terms = (unpacked_sorted(terms) - SHIFT).view(np.int64)
        sizes = unpacked(sizes, np.uint32).astype(np.int64)
        edges = np.concatenate([[0], np.cumsum(sizes)])
        steps = np.cumsum(unpacked(places, np.uint32).astype(np.int64))
        before = np.concatenate([[0], steps])[edges[:-1]]
        self.places = steps - np.repeat(before, sizes)
        self.first = edges  # the first posting of each term
        self.ids = unpacked(ids, np.int64)
        tf, lengths = unpacked(tfs, np.uint32).astype(np.float64), unpacked(lengths, np.uint32).astype(np.float64)
        self.impacts = tf * (K1 + 1) / (tf + K1 * (1 - B + B * lengths[self.places] / mean))
        span = self.places // SPAN
        fresh = np.ones(len(span), dtype=bool)
        fresh[1:] = span[1:] != span[:-1]
        fresh[edges[:-1]] = True
        self.starts = np.flatnonzero(fresh)  # the first posting of each block
        self.sizes = np.diff(np.append(self.starts, len(span)))
        self.span = span[self.starts]
        self.tops = np.maximum.reduceat(self.impacts, self.starts) if len(span) else np.zeros(0)
        self.edges = np.searchsorted(self.starts, edges)  # the first block of each term
        self.spans = -(-len(self.ids) // SPAN)

    def slots(self, terms: np.ndarray) -> np.ndarray:
        """The number of each term in the chunk, or -1."""
        at = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        return np.where(self.terms[at] == terms, at, -1)


def best_of(chunk: Chunk, slots: np.ndarray, weights: np.ndarray, k: int, scores: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The best k of (`scores`, `ids`) and the chunk's rows, for a query of the terms at `slots`."""
    counts = chunk.edges[slots + 1] - chunk.edges[slots]
    blocks = ragged(chunk.edges[slots], counts)
    weight = np.repeat(weights, counts)
    span = chunk.span[blocks]
    bound = np.bincount(span, chunk.tops[blocks] * weight, minlength=chunk.spans)
    bound *= 1 + 1e-9  # bounds are sums in another order than scores
    order = np.argsort(-bound, kind="stable")
    bounds = bound[order]
    turn = np.empty(chunk.spans, dtype=np.int64)
    turn[order] = np.arange(chunk.spans)
    turn = turn[span]
    done, step = 0, FIRST
    while done < chunk.spans:
        worst = scores[-1] if len(scores) == k else 0.0
        live = int(np.searchsorted(-bounds, -worst, side="left" if worst == 0 else "right"))
        if live <= done:
            break
        if done and 2 * live > chunk.spans:  # most spans have to be read: whole lists are read faster
            sums = _sums(chunk, slots, weights)
            fresh = np.ones(chunk.spans, dtype=bool)
            fresh[order[:done]] = False
            hit = np.flatnonzero((sums > 0) & (sums >= worst) & np.repeat(fresh, SPAN)[: len(sums)])
            place, sums, until = hit, sums[hit], chunk.spans
        else:
            until = min(live, done + step)
            own = np.flatnonzero((turn >= done) & (turn < until))
            sizes = chunk.sizes[blocks[own]]
            at = ragged(chunk.starts[blocks[own]], sizes)
            local = np.repeat(turn[own] - done, sizes) * SPAN + chunk.places[at] % SPAN
            sums = np.bincount(local, chunk.impacts[at] * np.repeat(weight[own], sizes), minlength=(until - done) * SPAN)
            hit = np.flatnonzero((sums > 0) & (sums >= worst))
            place, sums = order[done + hit // SPAN] * SPAN + hit % SPAN, sums[hit]
        scores, ids = np.append(scores, sums), np.append(ids, chunk.ids[place])
        if len(scores) > 4 * k:
            least = np.partition(scores, len(scores) - k)[len(scores) - k]
            scores, ids = scores[scores >= least], ids[scores >= least]
        by = np.lexsort((ids, -scores))[:k]
        scores, ids = scores[by], ids[by]
        done, step = until, step * 2
    return scores, ids


def _sums(chunk: Chunk, slots: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The scores of all places; a place's sum is taken in the same order of terms as by spans."""
    spans = list(zip(chunk.first[slots].tolist(), chunk.first[slots + 1].tolist()))
    places = np.concatenate([chunk.places[a:b] for a, b in spans])
    impacts = np.concatenate([chunk.impacts[a:b] for a, b in spans])
    impacts *= np.repeat(weights, [b - a for a, b in spans])
    return np.bincount(places, impacts, minlength=len(chunk.ids))


def _searched(batches: Iterator[pa.RecordBatch], mean: float, k: int) -> Iterator[pa.RecordBatch]:
    """A shard's chunks, then blocks of queries: the shard's best k of each query."""
    shard, chunks = None, []
    release_memory()  # what the worker holds from earlier tasks
    for batch in batches:
        for row in range(batch.num_rows):
            now, at = (batch.column(c)[row].as_py() for c in range(2))
            blobs = [batch.column(c)[row].as_buffer() for c in range(2, batch.num_columns)]  # not copied
            if now != shard:
                shard, chunks = now, []
            if at < 0:
                chunks.append(blobs)
            elif chunks:
                yield _answers(chunks, blobs, mean, k)
                release_memory()


class Unit:
    """Several chunks as a block of queries meets them: postings of the `asked` terms (sorted) alone.

    `often` has how many of the `queries` ask for each term. A product with a term's column takes as long
    whoever holds it, its list as long as there are pairs of a query and a document that both do. Places are ordered by the most common columns they hold, so that documents of one kind, such as a
    language, share spans.
    """

    def __init__(self, chunks: list[list[bytes]], asked: np.ndarray, often: np.ndarray, queries: int, mean: float):
        read = [list(x) for x in zip(*(self._read(blobs, asked, mean) for blobs in chunks))]
        docs = 0
        for part, keys in zip(read[1], read[-2]):
            part += docs
            docs += len(keys)

        def taken() -> np.ndarray:
            """The next field of all chunks; the parts are given back."""
            return np.concatenate(read.pop(0))

        term, doc, impact, self.term, self.tf = (taken() for _ in range(5))
        self.edges = np.concatenate([[0], np.cumsum(taken())])
        self.norms, keys, marks = (taken() for _ in range(3))

        counts = np.bincount(term, minlength=len(asked))
        dense = np.flatnonzero(counts * often * float(DENSE) ** 2 >= max(docs, 1) * queries)
        dense = dense[np.argsort(-counts[dense], kind="stable")][: COLUMNS // max(docs, 1)]
        self.column = np.full(len(asked), -1, dtype=np.int32)
        self.column[dense] = np.arange(len(dense))
        there = self.column[term] >= 0
        at, column = doc[there], self.column[term[there]]
        common = column < SORTED_BY
        kind = np.bincount(at[common], np.ldexp(1.0, -column[common]), minlength=docs)
        self.docs = np.argsort(kind, kind="stable")  # the document of each place
        self.keys, self.marks = keys[self.docs], marks[self.docs]
        place = np.empty(docs, dtype=np.int64)
        place[self.docs] = np.arange(docs)
        self.matrix = np.zeros((docs, len(dense)), dtype=np.float32)
        self.matrix[place[at], column] = impact[there]
        del at, column
        self.tops = np.maximum.reduceat(self.matrix, np.arange(0, docs, SPAN), axis=0) if docs else self.matrix

        rare = ~there
        by = np.argsort(term[rare], kind="stable")  # runs of ascending terms are merged
        both = place[doc[rare]] << 32
        both |= impact[rare].view(np.uint32)  # place and impact side by side, as they are read together
        self.lists = both[by]
        counts[dense] = 0
        self.first = np.concatenate([[0], np.cumsum(counts)])  # the first posting of each list
        self.margin = (len(dense) + 32) * 2.0**-23  # by which rounding may change a score, as a share of it

    @staticmethod
    def _read(blobs: list[bytes], asked: np.ndarray, mean: float) -> _Read:
        terms, sizes, places, tfs, keys, lengths, marks = blobs
        terms = (unpacked_sorted(terms) - SHIFT).view(np.int64)
        sizes = unpacked(sizes, np.uint32).astype(np.int64)
        at = np.minimum(np.searchsorted(asked, terms), len(asked) - 1)
        there = asked[at] == terms
        steps = np.cumsum(unpacked(places, np.uint32), dtype=np.int64)
        before = np.concatenate([[0], steps])[np.cumsum(sizes) - sizes]
        wanted, tf = np.repeat(there, sizes), unpacked(tfs, np.uint32)
        if there.all():
            place = steps
        else:
            place, tf = steps[wanted], tf[wanted]
        place -= np.repeat(before[there], sizes[there])
        term = np.repeat(at[there].astype(np.int32), sizes[there])
        keys = unpacked(keys, np.int64)
        norms = K1 * (1 - B + B * unpacked(lengths, np.uint32).astype(np.float64) / mean)
        impact = (tf * (K1 + 1) / (tf + norms[place])).astype(np.float32)
        order = np.argsort(place.astype(np.uint16) if len(keys) <= 1 << 16 else place, kind="stable")  # 16 bits are sorted by digits
        return _Read(term, place.astype(np.int32), impact, term[order], tf[order], np.bincount(place, minlength=len(keys)), norms, keys, unpacked(marks, np.uint64))

    def scores(self, bounds: np.ndarray, terms: np.ndarray, weights: np.ndarray, worst: np.ndarray) -> np.ndarray:
        """Scores of all places (columns) for queries (rows), rounded; too low in spans that cannot beat `worst`.

        A query's terms are numbers among the asked ones.
        """
        n, docs = len(bounds) - 1, len(self.docs)
        row, column = np.repeat(np.arange(n), np.diff(bounds)), self.column[terms]
        there, width = column >= 0, self.matrix.shape[1]
        wide = np.zeros((n, width), dtype=np.float32)
        wide[row[there], column[there]] = weights[there]
        sums = np.zeros((n, docs), dtype=np.float32)
        starts = self.first[terms]
        sizes = self.first[terms + 1] - starts
        held = sizes > 0
        edges = np.concatenate([[0], np.cumsum(held)])[bounds].tolist()
        starts, sizes, weights = starts[held], sizes[held], weights[held]
        for q, (a, b) in enumerate(zip(edges[:-1], edges[1:])):
            if a < b:
                both = self.lists[ragged(starts[a:b], sizes[a:b])]
                impact = both.view(np.float32)[LOW::2] * np.repeat(weights[a:b], sizes[a:b])
                sums[q] = np.bincount(both >> 32, impact, minlength=docs)
        if not width:
            return sums
        bound = wide @ self.tops.T
        bound += np.maximum.reduceat(sums, np.arange(0, docs, SPAN), axis=1)
        live = bound * (1 + 2 * self.margin) >= worst[:, None]
        for span, a in enumerate(range(0, docs, SPAN)):
            rows = np.flatnonzero(live[:, span])
            part = self.matrix[a : a + SPAN].T
            if 4 * len(rows) > 3 * n:
                sums[:, a : a + SPAN] += wide @ part
            elif len(rows):
                sums[rows, a : a + SPAN] += wide[rows] @ part
        return sums

    def exact(self, places: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """The scores of `places`, with `weights` of all asked terms; summed by ascending term, as everywhere.

        Rows of the same terms, as often, and of one length are summed once.
        """
        if len(places) > COPIES:
            _, first, back = np.unique(self.marks[places], return_index=True, return_inverse=True)
            if len(first) < len(places):
                return self.exact(places[first], weights)[back]
        docs, out = self.docs[places], np.empty(len(places))
        starts, ends = self.edges[docs], self.edges[docs + 1]
        sizes = ends - starts
        for a, b in slices(sizes, RESCORED) if sizes.sum() > RESCORED else [(0, len(docs))]:
            runs = list(zip(starts[a:b].tolist(), ends[a:b].tolist()))
            weight = weights[np.concatenate([self.term[x:y] for x, y in runs])]
            met = np.flatnonzero(weight)
            row = np.repeat(np.arange(b - a), sizes[a:b])[met]
            tf = np.concatenate([self.tf[x:y] for x, y in runs])[met]
            out[a:b] = np.bincount(row, tf * (K1 + 1) / (tf + self.norms[docs[a:b]][row]) * weight[met], minlength=b - a)
        return out


class _Read(NamedTuple):
    """A chunk's postings by (term, document), then by (document, term); and its documents."""

    term: np.ndarray
    doc: np.ndarray
    impact: np.ndarray
    term_by_doc: np.ndarray
    tf_by_doc: np.ndarray
    sizes: np.ndarray
    norms: np.ndarray
    keys: np.ndarray
    marks: np.ndarray


LOW = 0 if sys.byteorder == "little" else 1  # the half of a 64-bit number that holds its low bits


def best_of_unit(unit: Unit, bounds: np.ndarray, terms: np.ndarray, weights: np.ndarray, k: int, best: list[tuple[np.ndarray, np.ndarray]], wide: np.ndarray) -> None:
    """The best k of `best` (scores, keys) and the unit's rows, put in `best`, for queries of the `terms` and `weights`
    cut at `bounds`. `wide` holds a zero for every asked term."""
    worst = np.array([scores[-1] if len(scores) == k else 0.0 for scores, _ in best])
    sums = unit.scores(bounds, terms, weights, worst)
    least = np.maximum(worst * (1 - 2 * unit.margin), np.finfo(np.float32).tiny).astype(np.float32)
    for q, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
        places = np.flatnonzero(sums[q] >= least[q])
        if len(places) > k:
            near = sums[q][places]
            places = places[near >= np.partition(near, len(near) - k)[len(near) - k] * (1 - 4 * unit.margin)]
        if not len(places):
            continue
        wide[terms[a:b]] = weights[a:b]
        found = unit.exact(places, wide)
        wide[terms[a:b]] = 0
        hit = (found > 0) & (found >= worst[q])
        places, found = places[hit], found[hit]
        scores, keys = np.append(best[q][0], found), np.append(best[q][1], unit.keys[places])
        by = np.lexsort((keys, -scores))[:k]
        best[q] = scores[by], keys[by]


def _units(chunks: list[list[bytes]]) -> Iterator[list[list[bytes]]]:
    """Neighbouring chunks of about UNIT postings together."""
    for a, b in slices(np.array([size_of(c[CHUNK_COLUMNS.index("tfs")]) for c in chunks]), UNIT):
        yield chunks[a:b]


def _answers(chunks: list[list[bytes]], blobs: list[bytes], mean: float, k: int) -> pa.RecordBatch:
    queries, bounds = (unpacked(b, np.int64) for b in blobs[:2])
    asked = (unpacked_sorted(blobs[2]) - SHIFT).view(np.int64)
    terms = unpacked(blobs[3], np.uint32).view(np.int32)  # numbers among the asked ones
    weights = unpacked(blobs[4], np.float64)[unpacked(blobs[5], np.uint32)]
    best = [(np.zeros(0), np.zeros(0, dtype=np.int64))] * len(queries)
    if len(terms) >= MANY * len(queries):
        _by_units(chunks, bounds, asked, terms, weights, mean, k, best)
    else:
        _by_chunks(chunks, bounds, asked[terms], weights, mean, k, best)
    sizes = [len(s) for s, _ in best]
    columns = [np.repeat(queries, sizes), np.concatenate([i for _, i in best]), np.concatenate([s for s, _ in best])]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["query_id", "doc_id", "score"])


def _by_chunks(chunks: list[list[bytes]], bounds: np.ndarray, terms: np.ndarray, weights: np.ndarray, mean: float, k: int, best: list) -> None:
    for held in chunks:
        chunk = Chunk(held, mean)
        slots = chunk.slots(terms)
        for q, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
            own = slots[a:b]
            there = own >= 0
            if there.any():
                best[q] = best_of(chunk, own[there], weights[a:b][there], k, *best[q])


def _by_units(chunks: list[list[bytes]], bounds: np.ndarray, asked: np.ndarray, terms: np.ndarray, weights: np.ndarray, mean: float, k: int, best: list) -> None:
    # Rows that share a query's key may ask for one term with several weights, which add up.
    fresh = np.append(True, terms[1:] != terms[:-1])
    fresh[bounds[:-1]] = True
    if not fresh.all():
        at = np.flatnonzero(fresh)
        bounds, terms, weights = np.searchsorted(at, bounds), terms[at], np.add.reduceat(weights, at)
    wide, often = np.zeros(len(asked)), np.bincount(terms, minlength=len(asked))
    for held in _units(chunks):
        unit = Unit(held, asked, often, len(best), mean)
        step = max(1, CELLS // max(1, *unit.matrix.shape))
        for a in range(0, len(best) if len(unit.docs) else 0, step):
            edges = bounds[a : a + step + 1]
            some, b = slice(edges[0], edges[-1]), best[a : a + step]
            best_of_unit(unit, edges - edges[0], terms[some], weights[some], k, b, wide)
            best[a : a + step] = b
        del unit  # before the next is read
