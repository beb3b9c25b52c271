"""N-gram Jaccard join by vertical partitioning of the global n-gram order.

The global order of n-grams is that of their 64-bit hashes, and it is cut into fragments: ranges of
hashes. Every fragment is looked at by itself, twice:

1. All documents send a fragment the n-grams that fall into it. The fragment knows in how many
   different sets each one lies, and keeps those that lie in two at least; no other can be common.
2. For pairs that may link, each fragment counts the n-grams common to both sets in it; the partial
   counts are summed for each pair and decide.

Pairs that may link share one of their rarest n-grams: two sets of similarity t have one in common
among the first n - ceil(t * n) + 1 of each, whatever order is taken (the prefix filter), and by
frequency a passage that many documents hold comes last. Sizes, and what is left behind the common
n-gram, rule out most pairs.

A group of near copies is not compared pair by pair. Of the sets that share a rare n-gram, all are
compared with the smallest first; then only sets that this left in different groups are compared, those
outside the largest group with the others. What is compared but found equal needs no further pair.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landstrata.llm.blobs import packed, packed_sorted, unpacked, unpacked_sorted
from landstrata.llm.components import components
from landstrata.llm.text import mix, ragged, shingles, slices, utf8, word_hashes
from landstrata.session import materialise, materialise_observing, ship

# N-grams that a task gathers before it sends them to fragments, and those of one fragment on average.
GROUP = 1 << 21
FRAGMENT = 1 << 21
# Binary logarithm of the number of fragments in which the overlap of a pair is counted.
COUNTED = 4


def component_ids(docs: DataFrame, width: int = 5, threshold: tuple[int, int] = (80, 100), key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_shingles, component_id): the groups that links between documents make.

    Words are runs without ASCII white space, with A-Z as a-z. A document's set holds its distinct
    shingles of `width` words, or its whole sequence of words if that is shorter. Two documents link
    when intersection / union >= threshold[0] / threshold[1]. `component_id` is the smallest key that
    a document reaches by links, itself included.

    Null or empty texts have no shingles and link with nothing. Keys are integers that name one text
    each; a row that is repeated is returned as often. A row whose key is null gets a null component.
    Texts may be of any length. An empty table gives an empty result. Other columns of `docs` are not
    looked at.
    """
    ship(docs.sparkSession)
    docs = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    stats = docs.mapInArrow(partial(_sizes, width=width), "doc_id long, n_shingles long, digest binary")
    stats, seen = materialise_observing(stats, n=F.sum("n_shingles"))
    classes = stats.where("n_shingles > 0").groupBy("digest").agg(F.min("doc_id").alias("rep"))

    found = components(_links(docs.where("doc_id is not null"), seen["n"] or 0, width, threshold))
    named = classes.join(found, F.col("rep") == F.col("node"), "left")
    named = named.select("digest", F.coalesce("component", "rep").alias("component"))
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    out = stats.join(named, "digest", "left")
    return out.select(F.col("doc_id").alias(key), "n_shingles", component.alias("component_id"))


def _links(docs: DataFrame, total: int, width: int, threshold: tuple[int, int]) -> DataFrame:
    """Links (a, b) that join what all links join, between the smallest documents of equal sets."""
    sets = materialise(_sets(docs, total, width, threshold))
    rare = sets.select("doc_id", "n", "skipped", F.posexplode(F.slice("hashes", F.lit(1), F.col("in_prefix"))).alias("i", "hash"))
    rare = rare.select("hash", "doc_id", "n", (F.col("skipped") + F.col("i")).alias("place"))

    first = rare.groupBy("hash").agg(F.min(F.struct("doc_id", "n", "place")).alias("p"), F.count(F.lit(1)).alias("sets")).where("sets > 1")
    met = rare.join(first.select("hash", "p"), "hash").where((F.col("doc_id") > F.col("p.doc_id")) & _may_link("", "p.", threshold))
    pairs = met.select(F.col("p.doc_id").alias("a"), F.col("doc_id").alias("b"), F.col("p.n").alias("n_a"), F.col("n").alias("n_b"))
    near = materialise(_verified(sets, pairs.distinct(), threshold))

    label = components(near)
    rare = rare.join(label.withColumnRenamed("node", "doc_id"), "doc_id", "left").withColumn("component", F.coalesce("component", "doc_id"))
    rare = materialise(rare)
    split = rare.groupBy("hash", "component").agg(F.count(F.lit(1)).alias("sets")).groupBy("hash")
    split = split.agg(F.max_by("component", "sets").alias("main"), F.count(F.lit(1)).alias("groups")).where("groups > 1").select("hash", "main")
    apart = rare.join(split, "hash")
    other = apart.select("hash", *(F.col(c).alias(f"o_{c}") for c in ("doc_id", "n", "place", "component")), (F.col("component") == F.col("main")).alias("o_main"))
    once = F.col("o_main") | (F.col("doc_id") < F.col("o_doc_id"))
    met = apart.where("component <> main").join(other, "hash")
    met = met.where((F.col("component") != F.col("o_component")) & once & _may_link("", "o_", threshold))
    low = F.col("doc_id") < F.col("o_doc_id")
    pairs = met.select(
        F.least("doc_id", "o_doc_id").alias("a"), F.greatest("doc_id", "o_doc_id").alias("b"),
        F.when(low, F.col("n")).otherwise(F.col("o_n")).alias("n_a"), F.when(low, F.col("o_n")).otherwise(F.col("n")).alias("n_b"),
    )
    return near.unionByName(materialise(_verified(sets, pairs.distinct(), threshold)))


def _may_link(one: str, other: str, threshold: tuple[int, int]) -> Column:
    """Whether sets with a common n-gram at their places, and none before, may link by their sizes."""
    num, den = threshold
    x, y = F.col(f"{one}n"), F.col(f"{other}n")
    most = 1 + F.least(x - F.col(f"{one}place") - 1, y - F.col(f"{other}place") - 1)
    return (F.least(x, y) * den >= F.greatest(x, y) * num) & (most * den >= (x + y - most) * num)


def _verified(sets: DataFrame, pairs: DataFrame, threshold: tuple[int, int]) -> DataFrame:
    """Those of `pairs` (a, b, n_a, n_b) that link: overlaps are counted fragment by fragment, and summed."""
    num, den = threshold
    own = f"transform(sequence(0, {(1 << COUNTED) - 1}), f -> struct(f as fragment, filter(hashes, h -> shiftrightunsigned(h, {64 - COUNTED}) = f) as grams))"
    cut = sets.select("doc_id", F.explode(F.expr(own)).alias("f")).select("doc_id", "f.fragment", "f.grams").where("size(grams) > 0")
    left = pairs.join(cut.select(F.col("doc_id").alias("a"), "fragment", F.col("grams").alias("of_a")), "a")
    both = left.join(cut.select(F.col("doc_id").alias("b"), "fragment", F.col("grams").alias("of_b")), ["b", "fragment"])
    counted = both.select("a", "b", "n_a", "n_b", F.size(F.array_intersect("of_a", "of_b")).alias("common"))
    whole = counted.groupBy("a", "b", "n_a", "n_b").agg(F.sum("common").alias("common"))
    return whole.where(F.col("common") * den >= (F.col("n_a") + F.col("n_b") - F.col("common")) * num).select("a", "b")


def _sets(docs: DataFrame, total: int, width: int, threshold: tuple[int, int]) -> DataFrame:
    """(doc_id, n, skipped, in_prefix, hashes) of the sets that may link, one of each group of equal ones.

    `hashes` are the n-grams that other sets have too, the rarest first; `skipped` others of the n come
    before them, and the first `in_prefix` of them are among those of which a linked set has one.
    """
    bits = int(total // FRAGMENT).bit_length()
    sent = docs.mapInArrow(partial(_sent, width=width, bits=bits), "fragment long, docs binary, classes binary, sizes binary, hashes binary, owners binary")
    sent = sent.repartition("fragment").sortWithinPartitions("fragment")
    shared = sent.mapInArrow(partial(_shared, bits=bits), "bucket long, docs binary, sizes binary, held binary, hashes binary, often binary")
    shared = shared.repartition("bucket").sortWithinPartitions("bucket")
    return shared.mapInArrow(partial(_ordered, threshold=threshold), "doc_id long, n long, skipped long, in_prefix int, hashes array<long>")


# ---- inside a task -------------------------------------------------------------------------------


def _shingled(batch: pa.RecordBatch, width: int) -> Iterator[tuple]:
    """(ids, hashes, bounds) of slices of a batch."""
    data, offsets = utf8(batch.column("text"))
    for a, b in slices(np.diff(offsets)):
        words, bounds = word_hashes(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
        hashes, edges = shingles(words, bounds, width)
        yield batch.column("doc_id").slice(a, b - a), hashes, edges


def _digests(hashes: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """128 bits for each set, as two numbers."""
    out = np.zeros((len(edges) - 1, 2), dtype=np.uint64)
    held = np.diff(edges) > 0
    if held.any():
        for k, salt in enumerate((3, 7)):
            sums = np.add.reduceat(mix(hashes + np.uint64(salt)), edges[:-1][held])
            out[held, k] = mix(sums + np.diff(edges)[held].astype(np.uint64))
    return out


def _sizes(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for ids, hashes, edges in _shingled(batch, width):
            digests = [row.tobytes() for row in _digests(hashes, edges)]
            yield pa.RecordBatch.from_arrays([ids, pa.array(np.diff(edges)), pa.array(digests, pa.binary())], ["doc_id", "n_shingles", "digest"])


def _table(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = [pa.int64()] + [pa.binary()] * (len(names) - 1)
    return pa.RecordBatch.from_arrays([pa.array(list(c), type=t) for c, t in zip(zip(*rows), kinds)], names)


def _runs(values: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin, and the end."""
    return np.append(np.flatnonzero(np.append(True, values[1:] != values[:-1])[: len(values)]), len(values))


def _top(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(hashes), dtype=np.int64)


def _sent(batches: Iterator[pa.RecordBatch], width: int, bits: int) -> Iterator[pa.RecordBatch]:
    """N-grams of a group of documents, by fragment: the documents' ids, classes and sizes, the sorted
    hashes, and the numbers of the documents they are of. Of equal sets the smallest document's is sent."""
    names = ["fragment", "docs", "classes", "sizes", "hashes", "owners"]
    kept: list[tuple] = []
    held = 0

    def group() -> Iterator[pa.RecordBatch]:
        ids, hashes, sizes = (np.concatenate(x) for x in zip(*kept))
        edges = np.concatenate([[0], np.cumsum(sizes)])
        marks = _digests(hashes, edges)
        by = np.lexsort((ids, marks[:, 1], marks[:, 0]))
        fresh = np.append(True, (marks[by[1:]] != marks[by[:-1]]).any(axis=1))[: len(by)]
        chosen = by[fresh]
        chosen = np.sort(chosen[sizes[chosen] > 0])
        if not len(chosen):
            return
        grams = hashes[ragged(edges[chosen], sizes[chosen])]
        owner = np.repeat(np.arange(len(chosen)), sizes[chosen])
        by = np.argsort(grams)
        grams, owner = grams[by], owner[by]
        cuts = _runs(_top(grams, bits))
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            there, number = np.unique(owner[a:b], return_inverse=True)
            docs = chosen[there]
            own = (packed(ids[docs]), packed(marks[docs, 0]), packed(sizes[docs].astype(np.uint32)), packed_sorted(grams[a:b]), packed(number.astype(np.uint32)))
            yield _table([(int(_top(grams[a : a + 1], bits)[0]), *own)], names)

    for batch in batches:
        for ids, hashes, edges in _shingled(batch, width):
            kept.append((ids.to_numpy(), hashes, np.diff(edges)))
            held += len(hashes)
            if held >= GROUP:
                yield from group()
                kept, held = [], 0
    if held:
        yield from group()


def _grouped(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[int, list[dict]]]:
    """Neighbouring rows of one key."""
    now, rows = None, []
    for batch in batches:
        for k in range(batch.num_rows):
            row = {name: batch.column(name)[k].as_py() for name in batch.schema.names}
            if row[key] != now:
                if rows:
                    yield now, rows
                now, rows = row[key], []
            rows.append(row)
    if rows:
        yield now, rows


def _shared(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    """The n-grams of a fragment that lie in two different sets at least, with the number of those sets, by
    buckets of documents."""
    names = ["bucket", "docs", "sizes", "held", "hashes", "often"]
    for _, rows in _grouped(batches, "fragment"):
        grams = np.concatenate([unpacked_sorted(row["hashes"]) for row in rows])
        docs, classes, sizes, at, before = [], [], [], [], 0
        for row in rows:
            docs.append(unpacked(row["docs"], np.int64))
            classes.append(unpacked(row["classes"], np.uint64))
            sizes.append(unpacked(row["sizes"], np.uint32))
            at.append((unpacked(row["owners"], np.uint32) + np.uint32(before)).astype(np.int32))
            before += len(docs[-1])
        rows.clear()  # a task holds one copy of a fragment
        docs, classes, sizes, at = (np.concatenate(x) for x in (docs, classes, sizes, at))
        by = np.argsort(grams)
        grams, at = grams[by], at[by]
        del by
        cuts = _runs(grams)
        several = np.repeat(np.diff(cuts) > 1, np.diff(cuts))
        grams, at = grams[several], at[several]
        # Equal sets of several groups: the smallest document stays.
        by = np.lexsort((docs[at], classes[at], grams))
        grams, at = grams[by], at[by]
        fresh = np.append(True, (grams[1:] != grams[:-1]) | (classes[at[1:]] != classes[at[:-1]]))[: len(grams)]
        grams, at = grams[fresh], at[fresh]
        counts = np.diff(_runs(grams)) if len(grams) else np.zeros(0, dtype=np.int64)
        often = np.repeat(counts, counts)
        grams, at, often = grams[often > 1], at[often > 1], often[often > 1]
        ids = docs[at]
        bucket = _top(mix(ids.view(np.uint64)), bits)
        by = np.lexsort((ids, bucket))
        grams, ids, often, bucket, size = grams[by], ids[by], often[by], bucket[by], sizes[at[by]]
        cuts = _runs(bucket)
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            own = _runs(ids[a:b])
            first = a + own[:-1]
            blobs = (packed(ids[first]), packed(size[first]), packed(np.diff(own).astype(np.uint32)), packed(grams[a:b]), packed(often[a:b].astype(np.uint32)))
            yield _table([(int(bucket[a]), *blobs)], names)


def _ordered(batches: Iterator[pa.RecordBatch], threshold: tuple[int, int]) -> Iterator[pa.RecordBatch]:
    """The shared n-grams of every document of a bucket, the rarest first, if any is among those that a
    linked set must have one of."""
    num, den = threshold
    for _, rows in _grouped(batches, "bucket"):
        held = np.concatenate([unpacked(row["held"], np.uint32).astype(np.int64) for row in rows])
        ids, sizes = (np.concatenate([unpacked(row[c], t) for row in rows]) for c, t in (("docs", np.int64), ("sizes", np.uint32)))
        ids, sizes = np.repeat(ids, held), np.repeat(sizes.astype(np.int64), held)
        grams, often = (np.concatenate([unpacked(row[c], t) for row in rows]) for c, t in (("hashes", np.uint64), ("often", np.uint32)))
        by = np.lexsort((grams, often, ids))
        cuts = _runs(ids[by])
        first = by[cuts[:-1]]
        shared, n = np.diff(cuts), sizes[first]
        skipped = n - shared
        prefix = np.clip(n - -(-n * num // den) + 1 - skipped, 0, shared)
        chosen = np.flatnonzero(prefix > 0)
        grams = grams[by].view(np.int64)
        # Rows of at most some two million n-grams at a time.
        for a, b in slices(shared[chosen], GROUP):
            own = chosen[a:b]
            values = grams[ragged(cuts[own], shared[own])]
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(shared[own])]).astype(np.int32)), pa.array(values))
            arrays = [pa.array(ids[first[own]]), pa.array(n[own]), pa.array(skipped[own]), pa.array(prefix[own].astype(np.int32)), lists]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n", "skipped", "in_prefix", "hashes"])
