import hashlib
import random
import re
import sys
from pathlib import Path

import numpy as np

sys.path.insert(0, str(Path(__file__).resolve().parent))
from landstrata.llm import fim  # noqa: E402


def plain(key, text, seed="1"):
    """(n, form, prefix, middle, output) by slices of token lists."""
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text, re.S)
    said = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
    h = [int(said[8 * k : 8 * k + 8], 16) for k in range(4)]
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    prefix, middle, suffix = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return len(units), "plain", None, None, text
    if h[3] % 100 < 20:
        return len(units), "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return len(units), "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def texts(n):
    rng = random.Random(3)
    parts = ["a", "Bc", " ", "é", "日", "\n", "<", "P>", "S>", "<M", "1", "\0", "😀", "zzz"]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(n)]


def test_equals_slices_and_restores(spark):
    rows = [(k, t) for k, t in enumerate(texts(500))]
    rows += [(600, None), (601, ""), (None, "ab cd"), (None, None), (602, "<P>x"), (603, "x<S>"), (604, "<M>"), (605, "é" * 300_000 + "ab"), (606, "x" * 500_000), (1, rows[1][1])]
    df = spark.createDataFrame([(k, t, "clash", 5, 6) for k, t in rows], "doc_id long, text string, output string, form int, row int").repartition(5)
    out = fim.restored(fim.rearranged(df))
    assert out.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output", "restored"]
    got = [tuple(r) for r in out.collect()]
    want = [(k, *plain(k, t), t or "") for k, t in rows]
    order = lambda r: (r[0] is None, r[0] or 0, r[6])
    assert sorted(got, key=order) == sorted(want, key=order)
    assert {r[2] for r in got} == {"plain", "psm", "spm"}
    assert fim.restored(fim.rearranged(df.limit(0))).collect() == []


def test_restored_keeps_other_columns(spark):
    df = spark.createDataFrame([("<P>a<S>c<M>b", "psm", 1, "old"), ("no sentinels", "psm", 2, "old"), (None, None, 3, None), ("<S>c<P>a<M>b", "spm", 4, "")], "output string, form string, row int, restored string")
    got = fim.restored(df).select("row", "restored").collect()
    assert sorted(map(tuple, got)) == [(1, "abc"), (2, "no sentinels"), (3, ""), (4, "abc")]
    assert fim.restored(df).columns == ["output", "form", "row", "restored"]


def test_rotations(monkeypatch):
    for block in (1, 3, 1 << 16):
        monkeypatch.setattr(fim, "SWAP", block)
        for a, m, b in ((0, 0, 0), (0, 3, 9), (2, 2, 9), (1, 9, 9), (3, 4, 8), (0, 5, 10)):
            out = np.arange(10)
            fim.rotate(out, a, m, b)
            want = [*range(a), *range(m, b), *range(a, m), *range(b, 10)]
            assert out.tolist() == want
