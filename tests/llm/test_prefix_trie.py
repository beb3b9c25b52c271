import collections
import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from landstrata.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, x string, depth int"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def ordered(rows):
    """{conversation: its turns in order}"""
    held = collections.defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            role, text = role or "", text or ""
            mark = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            held[conv].append((turn is not None, turn or 0, mark, role, text))
    return {c: [t[3:] for t in sorted(turns)] for c, turns in held.items()}


def rebuilt(paths):
    out = {}
    for c, own in paths.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = paths.get(c - c % 5, [])[:h] + own[h:]
    return out


def plain(paths):
    """All nodes by their whole sequences of turns."""
    members = collections.defaultdict(list)
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append(c)
    children = collections.Counter(p[:-1] for p in members if p)
    out = []
    for node, held in members.items():
        under = [p for p in members if p[: len(node)] == node]
        saved = sum((len(members[p]) - 1) * len(p[-1][1].encode()) for p in under if p)
        ends = ",".join(str(c) for c in sorted(held) if len(paths[c]) == len(node))
        parent = min(members[node[:-1]]) if node else None
        out.append((min(held), len(node), parent, len(held), children[node], sum(not children[p] for p in under), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def found(spark, rows, block=4, rebuild=True):
    df = spark.createDataFrame(rows, SCHEMA).repartition(6)
    placed = prefix_trie.turns(df)
    out = prefix_trie.trie(prefix_trie.rebuilt(placed) if rebuild else placed, df.select("conv_id"), block)
    named = out.nodes.join(prefix_trie.end_digests(out.ends), prefix_trie.NODE, "left")
    named = named.withColumn("ends_sha256", F.coalesce("ends_sha256", F.sha2(F.lit(b""), 256)))
    return sorted((tuple(r) for r in named.select(COLUMNS).collect()), key=str)


def conversations(seed, n, length, words):
    """Few different turns, so that beginnings are shared."""
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(3 * n), n):
        for t in range(rng.randint(1, length)):
            rows.append((c, rng.choice([t, t, t, None, t // 2]), rng.choice(["user", "user", None]), rng.choice(words), "clash", 1))
    return rows + rows[:3]


@pytest.mark.parametrize("seed, n, length, words, block", [(1, 60, 9, ["a", "é日"], 4), (3, 50, 6, ["a", "b", None, "ccc"], 1), (4, 25, 30, ["a"], 3)])
def test_equals_whole_sequences(spark, monkeypatch, seed, n, length, words, block):
    monkeypatch.setattr(prefix_trie, "STRETCH", 2)  # long paths chain several stretches
    monkeypatch.setattr(prefix_trie, "PIECE", 3)
    rows = conversations(seed, n, length, words)
    paths = ordered(rows)
    assert found(spark, rows, block, rebuild=False) == plain(paths)
    assert found(spark, rows, block) == plain(rebuilt(paths))


def test_copies_and_one_long_conversation(spark, monkeypatch):
    """Half of all conversations are one; another holds a third of all turns."""
    monkeypatch.setattr(prefix_trie, "PIECE", 7)
    same = [(c, t, "user", f"turn {t}", "", 0) for c in range(0, 400, 5) for t in range(5)]
    other = [(c, t, "user", f"turn {t}" if t < c % 7 else f"{c} {t}", "", 0) for c in range(1, 300, 4) for t in range(4)]
    long = [(1000, t, "user", str(t % 3), "", 0) for t in range(350)]
    rows = same + other + long
    paths = ordered(rows)
    assert found(spark, rows) == plain(rebuilt(paths))


def test_odd_rows(spark):
    rows = [(None, 1, "u", "x", "", 0), (3, None, None, None, "", 0), (3, None, None, None, "", 0), (4, 1, "u", "", "", 0), (-7, 1, "u", "y" * 200_000, "", 0), (10**17, 2, "u", "z", "", 0)]
    assert found(spark, rows, rebuild=False) == plain(ordered(rows))
    assert found(spark, rows[:1]) == [] and found(spark, []) == []
    # A conversation whose own turns all give way to a leader that is not there: only the root.
    c = next(c for c in range(1, 100) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 1)
    alone = [(c, 0, "u", "x", "", 0)]
    want = [(c, 0, None, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())]
    assert found(spark, alone) == plain(rebuilt(ordered(alone))) == want
