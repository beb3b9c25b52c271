import collections
import random
import sys
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

from landstrata.llm import queries, search, text

sys.path.insert(0, str(Path(__file__).resolve().parent))
import brute  # noqa: E402

SCHEMA = "doc_id long, text string, term string, query_id int"


def chunk_of(rng, docs):
    """A chunk of texts over few words, and each row's term counts."""
    words = ["".join(rng.choice("abc") for _ in range(rng.randint(1, 3))) for _ in range(12)]
    ids = rng.sample(range(10 * docs), docs)
    texts = [" ".join(rng.choice(words) for _ in range(rng.choice([0, 1, 5, 30]))) + " z" for _ in ids]
    batch = pa.RecordBatch.from_pydict({"doc_id": ids, "text": texts})
    (found,) = search._indexed(iter([batch]))
    return search.Chunk([found.column(c)[0].as_py() for c in search.CHUNK_COLUMNS], 7.0)


@pytest.mark.parametrize("span", [1, 4, 32, 256])
def test_pruned_spans_lose_nothing(monkeypatch, span):
    """Any number of terms, ties, and scores taken along from another chunk."""
    monkeypatch.setattr(search, "SPAN", span)
    monkeypatch.setattr(search, "FIRST", 2)
    rng = random.Random(span)
    for trial in range(120):
        k, chunk = rng.choice([1, 3, 10]), chunk_of(rng, rng.choice([1, 20, 300]))
        slots = np.array(sorted(rng.sample(range(len(chunk.terms)), rng.randint(1, len(chunk.terms)))))
        weights = np.array([rng.choice([0.1, 1.0, 3.0]) for _ in slots])
        scores = collections.defaultdict(float)
        posting = np.repeat(np.arange(len(chunk.terms)), np.diff(np.append(chunk.starts, len(chunk.places))[chunk.edges]))
        for slot, weight in zip(slots, weights):
            for at in np.flatnonzero(posting == slot):
                scores[int(chunk.ids[chunk.places[at]])] += chunk.impacts[at] * weight
        before = sorted(((s * rng.choice([0.5, 1.0]), -1 - i) for i, s in enumerate(list(scores.values())[:k])), key=lambda x: (-x[0], x[1]))
        want = sorted([(s, i) for i, s in scores.items()] + before, key=lambda x: (-x[0], x[1]))[:k]
        got = search.best_of(chunk, slots, weights, k, np.array([s for s, _ in before]), np.array([i for _, i in before], dtype=np.int64))
        assert list(zip(*(x.tolist() for x in got))) == want


def test_spans_are_skipped(monkeypatch):
    """Postings of spans whose bound cannot beat the k-th best are not read."""
    rng = random.Random(2)
    texts = [("rare common" if k < 5 else "common") + " x" * rng.randint(20, 30) for k in range(2000)]
    monkeypatch.setattr(search, "SPAN", 32)
    (found,) = search._indexed(iter([pa.RecordBatch.from_pydict({"doc_id": list(range(2000)), "text": texts})]))
    chunk = search.Chunk([found.column(c)[0].as_py() for c in search.CHUNK_COLUMNS], 25.0)
    read = []
    plain = search.ragged
    monkeypatch.setattr(search, "ragged", lambda starts, sizes: read.append(int(sizes.sum())) or plain(starts, sizes))
    monkeypatch.setattr(search, "_sums", None)
    slots = chunk.slots(text.word_hashes(np.frombuffer(b"common rare", dtype=np.uint8), np.array([0, 11]), search.APART)[0].view(np.int64))
    scores, ids = search.best_of(chunk, slots, np.array([0.1, 5.0]), 3, np.zeros(0), np.zeros(0, dtype=np.int64))
    assert set(ids.tolist()) <= set(range(5)) and sum(read[1:]) < 500


def test_documents(spark, monkeypatch):
    monkeypatch.setattr(search, "CHUNK", 500)
    monkeypatch.setattr(search, "TERMS", 40)  # several blocks of queries
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").repartition(5)
    df, n, mean = search.statistics(docs)
    asked = search.telling_terms(docs.where("doc_id % 100 = 0"), df, n)
    got = collections.defaultdict(list)
    for r in sorted(search.search(docs, asked, mean).collect(), key=lambda r: (r.query_id, r.rank)):
        assert r.rank == len(got[r.query_id]) + 1
        got[r.query_id].append((r.doc_id, r.score))
    texts = {r.doc_id: r.text for r in docs.collect()}
    words = {k: collections.Counter(brute.re.findall(rb"[a-z0-9\x80-\xff]+", t.encode().translate(brute.LOWER))) for k, t in texts.items()}
    counted = collections.Counter(t for c in words.values() for t in c)
    assert n == len(texts) and mean == pytest.approx(sum(sum(c.values()) for c in words.values()) / n)
    queries = {}
    for key in (k for k in texts if k % 100 == 0):
        weights = {t: tf * brute.idf(n, counted[t]) for t, tf in words[key].items()}
        queries[key] = dict(sorted(weights.items(), key=lambda x: -x[1])[:16])
    want = brute.bm25(texts, queries, 10)
    assert set(got) == set(want)
    for key, rows in want.items():
        assert [k for k, _ in got[key]] == [k for k, _ in rows]
        assert [s for _, s in got[key]] == pytest.approx([s for _, s in rows])


def test_query_asks_for_whole_texts(spark, monkeypatch):
    """The registered query against brute force over all terms of each query row, in several blocks and shards."""
    monkeypatch.setattr(search, "CHUNK", 20_000)
    monkeypatch.setattr(search, "SHARD", 10_000)
    monkeypatch.setattr(search, "TERMS", 1000)
    got = collections.defaultdict(list)
    for r in sorted(queries.op8_exact_topk_search(spark, "/root/testdata/sf0.01").collect(), key=lambda r: (r.query_id, r.rank)):
        got[r.query_id].append((r.doc_id, r.score))
    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    words = {k: collections.Counter(brute.re.findall(rb"[a-z0-9\x80-\xff]+", t.encode().translate(brute.LOWER))) for k, t in texts.items()}
    counted = collections.Counter(t for c in words.values() for t in c)
    asked = {k: {t: tf * brute.idf(len(texts), counted[t]) for t, tf in words[k].items()} for k in texts if k % 100 == 0}
    assert max(map(len, asked.values())) > 100
    want = brute.bm25(texts, asked, 10)
    assert set(got) == set(want)
    for key, rows in want.items():
        assert [k for k, _ in got[key]] == [k for k, _ in rows]
        assert [s for _, s in got[key]] == pytest.approx([s for _, s in rows])


def test_odd_rows(spark):
    rows = [(5, "alpha beta"), (3, "Alpha, BETA!"), (7, None), (8, ""), (None, "alpha"), (5, "alpha beta"), (9, "gamma " * 100_000), (10, "...")]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    df, n, mean = search.statistics(docs)
    assert n == len(rows)
    asked = search.telling_terms(docs.where("doc_id in (3, 7, 9, 10)"), df, n)
    found = search.search(docs, asked, mean, k=2).collect()
    assert sorted((r.query_id, r.rank, r.doc_id) for r in found) == [(3, 1, 3), (3, 2, 5), (9, 1, 9)]  # a tie goes to the smaller key
    assert search.search(docs.limit(0), asked, mean).collect() == [] and search.search(docs, asked.limit(0), mean).collect() == []
    empty = docs.limit(0)
    assert search.statistics(empty)[1:] == (0, 1.0) and search.telling_terms(empty, df, n).collect() == []


def long_queries(rng, words, docs, length, queries, copies=0):
    """Chunks of texts over `words`, some of them copies, and a block that asks for the first texts' words."""
    texts = [" ".join(rng.choices(words, [1 / (i + 1) for i in range(len(words))], k=rng.choice([0, 1, length // 2, length]))) for _ in range(docs)]
    texts[docs - copies :] = rng.choices(texts[:queries], k=copies)
    ids = [rng.randrange(docs) for _ in texts]  # some keys more than once
    batches = pa.table({"doc_id": ids, "text": texts}).to_batches(max_chunksize=20)
    chunks = [[found.column(c)[0].as_py() for c in search.CHUNK_COLUMNS] for found in search._indexed(iter(batches))]
    rows = []
    for q in range(queries):
        terms = " ".join(rng.sample(words, 90)).encode()
        hashes = text.word_hashes(np.frombuffer(terms, dtype=np.uint8), np.array([0, len(terms)]), search.APART)[0]
        rows += sorted((0, q, int(t), rng.choice([0.25, 1.0, 3.5])) for t in hashes.view(np.int64))
    given = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], ["at", "query_id", "term", "weight"])
    (found,) = search._blocks(iter([given]))
    return texts, rows, chunks, [found.column(c)[0].as_py() for c in search.BLOCK_COLUMNS]


@pytest.mark.parametrize("docs,copies", [(1, 0), (300, 0), (700, 400)])
def test_matrices_find_what_lists_find(monkeypatch, docs, copies):
    """To the last bit, over several chunks, units, spans and slices of queries, with equal rows and repeated keys."""
    rng = random.Random(docs)
    words = sorted({"".join(rng.choice("abcdefg") for _ in range(4)) for _ in range(400)})
    for name, value in {"CHUNK": 1000, "UNIT": 2500, "COLUMNS": 10_000, "SPAN": 16, "CELLS": 1500, "COPIES": 4, "RESCORED": 300}.items():
        monkeypatch.setattr(search, name, value)
    for dense in (1, 8, 24, 10**6):
        monkeypatch.setattr(search, "DENSE", dense)
        _, _, chunks, block = long_queries(rng, words, docs, 60, 25, copies)
        assert len(chunks) > 2 or docs == 1
        got = []
        for many in (0, 10**9):
            monkeypatch.setattr(search, "MANY", many)
            got.append(search._answers(chunks, block, 31.0, 10))
        assert got[0].equals(got[1]) and (got[0].num_rows > 200 or docs == 1)


def test_common_terms_are_not_summed_one_by_one(monkeypatch):
    """Long queries meet nearly all rows by terms that many rows hold; few of these postings are added singly."""
    rng = random.Random(5)
    texts, rows, chunks, block = long_queries(rng, [a + b for a in "abcdefghij" for b in "abcdefghij"], 1500, 200, 30)
    asked = collections.Counter(term for _, _, term, _ in rows)
    frequency = collections.Counter()
    for t in texts:
        frequency.update(set(text.word_hashes(np.frombuffer(t.encode(), dtype=np.uint8), np.array([0, len(t)]), search.APART)[0].view(np.int64).tolist()))
    summed, plain = [], np.bincount
    monkeypatch.setattr(search.np, "bincount", lambda x, weights=None, minlength=0: summed.append(0 if weights is None else len(x)) or plain(x, weights, minlength))
    assert search._answers(chunks, block, 90.0, 10).num_rows == 300
    assert sum(summed) < sum(n * frequency[t] for t, n in asked.items()) / 10
