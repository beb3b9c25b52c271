import collections
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))
import brute  # noqa: E402
from landstrata.llm import lm_score, queries

PRIOR = 3.0


def tokens(text):
    return [*brute.WORDS.findall((text or "").encode().translate(brute.LOWER)), "end"]


def plain(rows, order, prior=lm_score.PRIOR):
    """[(id, learns, n_tokens, n_known, train_tokens, base, score)] of [(id, learns, text)], n-gram by n-gram."""
    counts, after = collections.Counter(), collections.Counter()
    for _, learns, text in rows:
        said = ["begin", *tokens(text)]
        for k in range(1, len(said)) if learns else ():
            for size in range(1, order + 1):
                if size <= k + 1:
                    counts[tuple(said[k - size + 1 : k + 1])] += 1
                    after[tuple(said[k - size + 1 : k])] += 1
    n, v = after[()], sum(len(g) == 1 for g in counts)

    def chance(history, word):
        if not history:
            return (counts[(word,)] + 1) / (n + v + 1)
        return (counts[(*history, word)] + prior * chance(history[1:], word)) / (after[history] + prior)

    out = []
    for key, learns, text in rows:
        said = ["begin", *tokens(text)]
        base = sum(math.log10(chance((), w)) for w in said[1:])
        full = sum(math.log10(chance(tuple(said[max(0, k - order + 1) : k]), said[k])) for k in range(1, len(said)))
        out.append((key, learns, len(said) - 1, sum(counts[(w,)] > 0 for w in said[1:]), n, base, full))
    return out


def equal(got, want):
    order = lambda r: (r[0] is None, r[0] or 0, r[6])
    got, want = sorted(map(tuple, got), key=order), sorted(want, key=order)
    assert len(got) == len(want)
    for a, b in zip(got, want):
        assert a[:5] == b[:5] and a[5:] == pytest.approx(b[5:], rel=1e-9, abs=1e-9)


def made(seed, n):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abAB") for _ in range(rng.randint(1, 4))) for _ in range(25)]
    texts = [rng.choice([" ", "\n\t"]).join(rng.choice(words) for _ in range(rng.choice([0, 1, 2, 5, 40]))) for _ in range(n)]
    return [(k, rng.random() < 0.7, t) for k, t in enumerate(texts)]


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_equals_a_plain_evaluation(spark, monkeypatch, order):
    """Many groups, shards and pieces."""
    monkeypatch.setattr(lm_score, "SHARD", 64)
    rows = made(order, 80)
    rows += [(100, True, rows[3][2]), (101, None, "a b"), (102, True, None), (None, False, "a zzz"), (102, True, None), (103, True, "word " * 3000 + "a b ab")]
    df = spark.createDataFrame([(k, l, t, 1, "x") for k, l, t in rows], "doc_id long, learn boolean, text string, n int, part string").repartition(7)
    got = lm_score.score(df, F.col("learn"), order, PRIOR)
    assert got.columns == ["doc_id", "learns", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    equal(got.collect(), plain([(k, bool(l), t) for k, l, t in rows], order, PRIOR))


def test_no_rows_and_no_training(spark):
    df = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    assert lm_score.score(df.limit(0), F.lit(True)).collect() == []
    (row,) = lm_score.score(df, F.lit(False)).collect()
    assert tuple(row) == (1, False, 3, 0, 0, 0.0, 0.0)


def test_groups_and_pieces_do_not_matter(monkeypatch):
    rows = made(9, 60)
    words, tokens_, sizes, learns = encoded([t for _, _, t in rows], [l for _, l, _ in rows])
    held = lm_score.grams(words, tokens_, sizes, learns, 3)
    machine = lm_score.automaton(held, [h.counts for h in held], 1000.0, int(learns.sum()), PRIOR)
    whole = lm_score.traverse(machine, tokens_, sizes, 3, piece=10_000)
    for piece in (1, 2, 7):
        assert np.allclose(lm_score.traverse(machine, tokens_, sizes, 3, piece=piece), whole, atol=1e-9)


def encoded(texts, learns):
    every = [tokens(t) for t in texts]
    names = sorted({w for t in every for w in t}, key=str)
    number = {w: k for k, w in enumerate(names)}
    hashes = np.array([zlib.crc32(str(w).encode()) for w in names], dtype=np.uint64)
    return hashes, np.array([number[w] for t in every for w in t]), np.array([len(t) for t in every]), np.array(learns, dtype=bool)


def test_histories_sum_to_one():
    """Over all words and the unknown one, for every state."""
    words, tokens_, sizes, learns = encoded(["a b a c", "b b", "c a b", "a"], [True] * 4)
    held = lm_score.grams(words, tokens_, sizes, learns, 3)
    n, v = len(tokens_), len(words)
    machine = lm_score.automaton(held, [h.counts for h in held], n + v + 1, 4, PRIOR)
    end = tokens_[-1]
    goes_on = machine.target[machine.arcs % v != end].tolist() + np.delete(machine.enter, end).tolist()
    assert len({0, machine.begin, *goes_on}) > 8
    for state in {0, machine.begin, *goes_on}:  # nothing follows a text's end
        _, gained = lm_score._step(machine, np.full(v, state), np.arange(v))
        left, at = 0.0, state
        while at:
            left, at = left + machine.backoff[at], machine.fail[at]
        assert (10**gained).sum() + 10**left / (n + v + 1) == pytest.approx(1)


def test_packing_of_numbers():
    rng = np.random.default_rng(1)
    values = np.sort(rng.integers(0, 1 << 63, 1000).astype(np.uint64) * np.uint64(2))
    assert (lm_score.unpacked_sorted(lm_score.packed_sorted(values)) == values).all()
    few = rng.integers(0, 9, 77).astype(np.uint32)
    assert (lm_score.unpacked(lm_score.packed(few), np.uint32) == few).all()
    assert len(lm_score.unpacked(lm_score.packed(few[:0]), np.uint32)) == 0


def test_query_on_the_tables(spark, sf):
    """All rows of the smallest tables against the plain evaluation; held-out texts gain by their histories."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    rows = [(r.doc_id, zlib.crc32(str(r.doc_id).encode()) % 7 != 2, r.text) for r in docs]
    out = queries.QUERIES["op13_lm_score"](spark, sf)
    got = out.select("doc_id", ~F.col("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score").collect()
    equal(got, plain(rows, lm_score.ORDER))
