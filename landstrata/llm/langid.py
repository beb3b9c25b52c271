"""Language identification: multinomial naive Bayes over hashed character n-grams.

Counts per language and bucket are summed by Spark; the matrix of log probabilities has a fixed number
of buckets and one column a language, so it is small and broadcast. A text's n-grams are looked up in
the matrix and summed, whole batches at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache, partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landstrata.llm.text import mix, slices
from landstrata.session import ship

SIZES = (1, 2, 3)  # characters of an n-gram
BITS = 16  # 2**BITS buckets
SMOOTH = 0.5
PIECE = 200_000  # characters handled at once
UNKNOWN = "und"


class Model(NamedTuple):
    languages: list[str]
    weights: np.ndarray  # (bucket, language): log probability of the bucket
    prior: np.ndarray  # log share of the learned documents


def held_out(key: str = "doc_id", folds: int = 5) -> Column:
    """Whether a document is kept from learning; null for a null key."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % folds == 0


def learn(docs: DataFrame, text: str = "text", lang: str = "lang") -> Model:
    """Counts n-grams of all rows whose text and language are given.

    What reaches the driver is one number per language and bucket, whatever the number of rows.
    Without such rows the model knows no language.
    """
    ship(docs.sparkSession)
    labelled = docs.select(F.col(text).alias("text"), F.col(lang).cast("string").alias("lang")).where("text is not null and lang is not null")
    partial_counts = labelled.mapInArrow(_counts, "lang string, bucket array<int>, seen array<long>")
    long = partial_counts.select("lang", F.explode(F.arrays_zip("bucket", "seen")).alias("x")).select("lang", "x.bucket", "x.seen")
    table = long.groupBy("lang", "bucket").agg(F.sum("seen").alias("seen")).toPandas()
    languages = sorted(table["lang"].unique())
    counts = np.zeros((1 << BITS, len(languages)))
    rows = np.zeros(len(languages))
    for k, name in enumerate(languages):
        own = table[table["lang"] == name]
        grams = own[own["bucket"] >= 0]
        counts[grams["bucket"].to_numpy(), k] = grams["seen"].to_numpy()
        rows[k] = own[own["bucket"] < 0]["seen"].sum()
    total = counts.sum(axis=0) + SMOOTH * (1 << BITS)
    weights = np.log((counts + SMOOTH) / total).astype(np.float32)
    return Model(languages, weights, np.log(rows / rows.sum()) if len(rows) else rows)


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """`docs` with `lang_pred` and `score`, the probability of that language among the learned ones.

    A text that is null or has no letter is `und` with score 0, and so is every text if the model knows
    no language. Columns of `docs` by these two names are replaced. Only `text` is looked at; ties go
    to the language that sorts first. Repeated rows are kept.
    """
    spark = ship(docs.sparkSession)
    kept = [c for c in docs.columns if c not in ("lang_pred", "score")]
    shared = spark.sparkContext.broadcast(model)
    schema = docs.select(*kept).schema.add("lang_pred", "string").add("score", "double")
    return docs.select(*kept).mapInArrow(partial(_predicted, text=text, model=shared), schema)


# ---- inside a task -------------------------------------------------------------------------------


@cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)


def _pieces(texts: list[str | None]) -> Iterator[tuple[int, str, int]]:
    """(number of the text, piece, how many of the piece's n-grams count): long texts come in pieces."""
    for k, text in enumerate(texts):
        lower = (text or "").replace("\0", " ").lower()
        for a in range(0, max(len(lower), 1), PIECE):
            yield k, lower[a : a + PIECE + max(SIZES) - 1], min(PIECE, len(lower) - a)


def ngrams(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(text numbers, bounds, buckets), for some texts and one size of n-gram at a time.

    N-grams hold one letter at least; every other character counts as a blank.
    """
    letters = _letters()
    pieces = list(_pieces(texts))
    for a, b in slices(np.array([len(p[1]) + 1 for p in pieces]), PIECE):
        joined = "\0".join(p[1] for p in pieces[a:b]) + "\0"
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        edges = np.concatenate([[0], np.cumsum([len(p[1]) + 1 for p in pieces[a:b]])])
        numbers = np.array([p[0] for p in pieces[a:b]])
        letter = letters[points]
        end = points == 0
        values = np.where(letter | end, points, np.uint32(32)).astype(np.uint64)
        fit = ~end
        for (_, piece, n), at in zip(pieces[a:b], edges):
            fit[at + n : at + len(piece)] = False  # begins in the next piece of the text
        hashed, some = np.zeros(len(points), dtype=np.uint64), np.zeros(len(points), dtype=bool)
        for n in range(1, max(SIZES) + 1):
            k = n - 1
            size = len(points) - k
            hashed = hashed[:size] * np.uint64(0x9E3779B97F4A7C15) + values[k:]
            fit = fit[:size] & ~end[k:]
            some = some[:size] | letter[k:]
            if n in SIZES:
                at = np.flatnonzero(fit & some)
                buckets = (mix(hashed[at] + np.uint64(n)) >> np.uint64(64 - BITS)).astype(np.int64)
                yield numbers, np.searchsorted(at, edges), buckets


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row a language of this task; bucket -1 has the number of texts."""
    counts: dict[str, np.ndarray] = {}
    for batch in batches:
        langs = batch.column("lang").to_pylist()
        names = sorted(set(langs))
        for name in langs:
            counts.setdefault(name, np.zeros((1 << BITS) + 1, dtype=np.int64))[-1] += 1
        code = np.array([names.index(name) for name in langs], dtype=np.int64) << BITS
        for numbers, bounds, buckets in ngrams(batch.column("text").to_pylist()):
            seen = np.bincount(buckets + np.repeat(code[numbers], np.diff(bounds)), minlength=len(names) << BITS)
            for name, own in zip(names, seen.reshape(len(names), -1)):
                counts[name][:-1] += own
    for name, seen in counts.items():
        at = np.flatnonzero(seen)
        buckets = np.where(at == 1 << BITS, -1, at).astype(np.int32)
        yield pa.RecordBatch.from_pydict({"lang": [name], "bucket": pa.array([buckets], pa.list_(pa.int32())), "seen": pa.array([seen[at]], pa.list_(pa.int64()))})


def _predicted(batches: Iterator[pa.RecordBatch], text: str, model: Broadcast) -> Iterator[pa.RecordBatch]:
    languages, weights, prior = model.value
    for batch in batches:
        sums = np.zeros((batch.num_rows, len(languages)))
        seen = np.zeros(batch.num_rows, dtype=np.int64)
        for numbers, bounds, buckets in ngrams(batch.column(text).to_pylist()):
            np.add.at(seen, numbers, np.diff(bounds))
            held = np.diff(bounds) > 0
            if held.any() and languages:
                np.add.at(sums, numbers[held], np.add.reduceat(weights[buckets], bounds[:-1][held], axis=0, dtype=np.float64))
        names, scores = [UNKNOWN] * batch.num_rows, np.zeros(batch.num_rows)
        if languages:
            sums += prior
            best = sums.argmax(axis=1)
            odds = np.exp(sums - sums.max(axis=1, keepdims=True))
            for k in np.flatnonzero(seen):
                names[k], scores[k] = languages[best[k]], odds[k, best[k]] / odds[k].sum()
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(names, pa.string()), pa.array(scores)], [*batch.schema.names, "lang_pred", "score"])
