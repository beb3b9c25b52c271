import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import public_tokenizers
from landstrata.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = [
    "", " ", "\n", "'s it's I'LL we're 'S ''s 'll've x's. ' s ''", "a  b\n\n c d　e  ", "<|endoftext|>hi there", "été ñ 12³½ Ⅷ ٣",
    " 日本語 テスト 한국어 ไทย\t\t x", "x" * 300, "😀👍🏽 a​b﻿ \x00\x1f\x85 \x85", "don't 'tis rock'n'roll 'd", "  \n  x \n\n\n", ". 'l 've 'ver 'r",
]


def test_encodes_as_the_library(monkeypatch):
    rng = random.Random(3)
    texts = ODD + ["".join(rng.choice(" '\nab1.é'srtvl ") for _ in range(rng.randint(1, 40))) for _ in range(2000)]
    library = Tokenizer.from_file(PATH)
    for piece, remembered in ((200_000, 10**6), (13, 50)):  # long texts in pieces; a memory that overflows
        monkeypatch.setattr("landstrata.llm.pretoken.PIECE", piece)
        coder = packing.ByteBpe(PATH)
        coder.spans.remembered = remembered
        got = {}
        for k, ids in coder.encoded(texts):
            got.setdefault(k, []).extend(ids.tolist())
        for k, text in enumerate(texts):
            assert got.get(k, []) == library.encode(text, add_special_tokens=False).ids, text


@pytest.mark.parametrize("seed", range(6))
def test_arrangement_uses_every_piece_once(seed):
    rng = random.Random(seed)
    capacity = rng.choice([7, 64, 1024])
    counts = {n: rng.choice([0, 1, 2, 5, 10**9]) for n in rng.sample(range(1, capacity + 1), min(capacity, rng.randint(1, 400)))}
    used = {}
    arranged = packing.arrangement(counts, capacity)
    for lengths, copies in arranged:
        assert sum(lengths) <= capacity and copies > 0
        for n in lengths:
            used[n] = used.get(n, 0) + copies
    assert used == {n: c for n, c in counts.items() if c}
    first_fit = sum(c / (capacity // n) for n, c in counts.items())  # every length by itself
    assert sum(c for _, c in arranged) <= first_fit + len(counts)


def test_exact_fillings():
    assert packing.arrangement({6: 2, 4: 2}, 10) == [((6, 4), 2)]
    assert packing.arrangement({5: 3, 3: 3, 2: 3}, 10) == [((5, 5), 1), ((5, 3, 2), 1), ((3, 3, 2, 2), 1)]
    assert sorted(packing.arrangement({7: 3, 4: 5}, 10)) == [((4,), 1), ((4, 4), 2), ((7,), 3)]


def best_fit_decreasing(counts, capacity):
    """Number of sequences, piece by piece."""
    gaps = []
    for length in sorted((n for n, c in counts.items() for _ in range(c)), reverse=True):
        fitting = [(g, k) for k, g in enumerate(gaps) if g >= length]
        if fitting:
            gaps[min(fitting)[1]] -= length
        else:
            gaps.append(capacity - length)
    return len(gaps)


@pytest.mark.parametrize("seed", range(12))
def test_never_more_sequences_than_best_fit_decreasing(seed):
    rng = random.Random(seed)
    capacity = rng.choice([10, 100, 1024])
    counts = {}
    for _ in range(rng.choice([5, 100, 800])):
        n = min(capacity, max(1, int(rng.choice([rng.uniform(1, capacity), rng.expovariate(4 / capacity), capacity * 0.45]))))
        counts[n] = counts.get(n, 0) + 1
    assert sum(c for _, c in packing.arrangement(counts, capacity)) <= best_fit_decreasing(counts, capacity)


def test_sequences_of_the_tables(spark):
    """964 by best-fit decreasing; no packing has fewer than 962."""
    rows = packing.pack(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), PATH)
    lengths = {r.length: r.n for r in rows.groupBy("length").agg(F.count("*").alias("n")).collect()}
    used = rows.select("sequence_id").distinct().count()
    assert used <= best_fit_decreasing(lengths, 1024)


def check(rows, texts, capacity=1024):
    library = Tokenizer.from_file(PATH)
    pieces, places = {}, {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append(r)
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for key, text in texts.items():
        ids = np.array(library.encode(text or "", add_special_tokens=False).ids + [2], dtype="<u4")
        own = sorted(pieces[key], key=lambda r: r.piece)
        assert [r.piece for r in own] == list(range(len(own))) and sum(r.length for r in own) == len(ids)
        assert all(r.length == capacity for r in own[1:]) and own[0].length <= capacity and len(own) == -(-len(ids) // capacity)
        for r in own:
            assert r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes())
    for own in places.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    assert len(places) <= 1.02 * sum(r.length for r in rows) / capacity + 1


def test_packs_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = packing.pack(docs.repartition(6), PATH).collect()
    check(rows, {r.doc_id: r.text for r in docs.collect()})


def test_odd_rows(spark):
    texts = {i: t for i, t in enumerate(ODD)} | {50: None, 51: "long text " * 20_000}
    df = spark.createDataFrame([(k, t, 1, "x") for k, t in texts.items()], "doc_id long, text string, length int, piece string")
    out = packing.pack(df, PATH)
    assert dict(out.dtypes) == {"doc_id": "bigint", "piece": "int", "start": "bigint", "length": "bigint", "ids_crc32": "bigint", "sequence_id": "bigint", "offset": "bigint"}
    check(out.collect(), texts)
    twice = packing.pack(df.where("doc_id in (3, 50)").unionByName(df.where("doc_id in (3, 50)")).withColumn("doc_id", F.when(F.col("doc_id") == 3, 3)), PATH).collect()
    assert len(twice) == 4 and len({(r.sequence_id, r.offset) for r in twice}) == 4 and {r.doc_id for r in twice} == {3, None}
    assert packing.pack(df.limit(0), PATH).collect() == []
