import random
import sys
from pathlib import Path

import numpy as np
import pytest

from landstrata.llm import components, ngram_join, text

sys.path.insert(0, str(Path(__file__).resolve().parent))
import brute  # noqa: E402

SCHEMA = "doc_id long, text string, n_shingles string, sig int"


def corpus(seed, sizes, copies):
    """Texts with copies of which some words are replaced, dropped or put in."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 4)))
    texts = []
    for _ in range(sizes[0]):
        base = [word() for _ in range(rng.randint(*sizes[1]))]
        texts.append(base)
        for _ in range(rng.randint(0, copies)):
            own = list(base)
            for _ in range(rng.randint(0, max(1, len(own) // 25))):
                at = rng.randrange(len(own)) if own else 0
                own[at : at + rng.randint(0, 1)] = [word() for _ in range(rng.randint(0, 2))]
            texts.append(own)
    return {i * 3 + 1: rng.choice([" ", "\n", "  "]).join(w.upper() if rng.random() < 0.1 else w for w in words) for i, words in enumerate(texts)}


def found(spark, texts, **options):
    rows = [(k, t, "clash", 7) for k, t in texts.items()]
    out = ngram_join.component_ids(spark.createDataFrame(rows, SCHEMA).repartition(5), **options)
    assert out.columns == ["doc_id", "n_shingles", "component_id"]
    return {r.doc_id: (r.n_shingles, r.component_id) for r in out.collect()}


@pytest.mark.parametrize(
    "seed, sizes, copies, width, threshold",
    [(1, (25, (20, 120)), 6, 4, (85, 100)), (2, (60, (1, 14)), 4, 4, (85, 100)), (3, (25, (5, 60)), 6, 5, (80, 100)), (4, (8, (150, 300)), 8, 2, (60, 100))],
)
def test_equals_all_pairs(spark, seed, sizes, copies, width, threshold):
    texts = corpus(seed, sizes, copies)
    assert found(spark, texts, width=width, threshold=threshold) == brute.groups(texts, width, *threshold)


def test_large_groups(spark, monkeypatch):
    """Chains of near copies, sent by small groups to many fragments."""
    monkeypatch.setattr(ngram_join, "GROUP", 500)
    monkeypatch.setattr(ngram_join, "FRAGMENT", 300)
    rng = random.Random(5)
    base = [f"w{i}" for i in range(60)]
    texts = {}
    for k in range(70):
        texts[k] = " ".join(base)
        at = rng.randrange(len(base))
        base[at] = f"x{k}"
    first = [f"v{i}" for i in range(150)]
    for k in range(100, 190):  # near copies of one text, and some of theirs
        own = texts[rng.choice(range(101, k))].split() if k > 150 else list(first)
        for _ in range(rng.randint(1, 7)):
            own[rng.randrange(len(own))] = f"y{k}{rng.random()}"
        texts[k] = " ".join(own if k > 100 else first)
    for k in range(200, 240):  # a passage that many texts hold, and exact copies of one of them
        texts[k] = " ".join([*(f"p{i}" for i in range(40)), *(f"z{k}{i}" for i in range(rng.randint(0, 30)))])
        texts[k + 100] = texts[200]
    want = brute.groups(texts, 4, 85, 100)
    assert found(spark, texts, width=4, threshold=(85, 100)) == want
    assert 3 < len({c for _, c in want.values()}) < 190


def test_pairs_grow_with_the_groups_not_their_squares(spark, monkeypatch):
    """Of a group of near copies, sets meet the smallest one; its other pairs are not asked for."""
    asked = []
    plain = ngram_join._verified
    monkeypatch.setattr(ngram_join, "_verified", lambda sets, pairs, threshold: asked.append(pairs.count()) or plain(sets, pairs, threshold))
    base = [f"w{i}" for i in range(100)]
    texts = {k: " ".join(base[:k] + [f"x{k}"] + base[k + 1 :]) for k in range(100)}
    assert {c for _, c in found(spark, texts).values()} == {0}
    assert asked == [99, 0]


def test_odd_rows(spark):
    texts = [(5, "a b c d e f g"), (3, "A b C d e f g"), (7, None), (8, ""), (9, " \n "), (5, "a b c d e f g"), (None, "a b c d e f g"), (11, "a"), (12, "a"), (13, "a b"), (14, "word " * 5000)]
    df = spark.createDataFrame([(k, t, "x", 0) for k, t in texts], SCHEMA)
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.component_ids(df, width=4).collect()), key=str)
    want = [(11, 1, 11), (12, 1, 11), (13, 1, 13), (14, 1, 14), (3, 4, 3), (5, 4, 3), (5, 4, 3), (7, 0, 7), (8, 0, 8), (9, 0, 9), (None, 4, None)]
    assert got == sorted(want, key=str)
    assert ngram_join.component_ids(df.limit(0)).collect() == []


def test_components(spark):
    links = [(i, i + 1) for i in range(200)] + [(1000 + i, 1000) for i in range(50)] + [(7, 7), (2000, 2001), (2001, 2000), (3000, None)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = {i: 0 for i in range(201)} | {1000 + i: 1000 for i in range(50)} | {2000: 2000, 2001: 2000}
    assert got == want
    assert components.components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_tables():
    table = text.HashTable(bits=3)
    keys = np.unique(np.random.default_rng(1).integers(0, 1 << 62, 5000)).astype(np.uint64)
    for a in range(0, len(keys), 700):
        table.add(keys[a : a + 700])
    assert (table.find(keys) == np.arange(len(keys))).all() and (table.find(keys + np.uint64(1 << 63)) == -1).all()
