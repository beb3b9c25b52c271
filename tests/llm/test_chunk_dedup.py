import difflib
import random

import numpy as np
import pytest

from landstrata.llm import chunk_dedup

SCHEMA = "doc_id long, text string, start string, words int"


def frame(spark, rows):
    return spark.createDataFrame([(k, t, "clash", 1) for k, t in rows], SCHEMA).repartition(4)


def words(rng, n, letters="abcdefghijäß"):
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(1, 9))) for _ in range(n))


def test_planted_passages_are_cut_from_the_later_document(spark):
    """Passages of 51 words at other places of two documents; all else is left alone."""
    rng = random.Random(1)
    rows, passages = [], {}
    for k in range(0, 300, 2):
        passage = words(rng, 51)
        passages[k + 1] = passage
        rows += [(k + i, f"{words(rng, rng.randint(0, 60))} {passage} {words(rng, rng.randint(0, 60))}") for i in range(2)]
    rows += [(1000 + k, words(rng, 300)) for k in range(40)]
    texts = dict(rows)
    found = {}
    for r in chunk_dedup.repeated_spans(frame(spark, rows)).collect():
        found.setdefault(r.doc_id, []).append(r)
    assert set(found) == set(passages)
    for key, spans in found.items():
        (span,) = spans
        cut = texts[key].encode()[span.start : span.end].decode()
        assert key - 1 in span.kept_in and span.words >= chunk_dedup.MIN_WORDS and abs(len(cut.split()) - span.words) <= 1
        # Within the passage, but for a short chunk beside it that other documents happen to have too.
        inside = difflib.SequenceMatcher(None, cut, passages[key], autojunk=False).find_longest_match()
        assert inside.size >= len(cut) - 12
    left = {r.doc_id: r.text for r in chunk_dedup.without_repeats(frame(spark, rows)).collect()}
    for key, text in texts.items():
        if key in passages:
            (span,) = found[key]
            data = text.encode()
            assert left[key] == (data[: span.start] + data[span.end :]).decode()
        else:
            assert left[key] == text


def test_cuts_meet_again_after_an_insertion():
    rng = random.Random(2)
    body = words(rng, 400).encode()
    for prefix in (b"", b"x", b"some more words ", "é".encode() * 41):
        data = np.frombuffer(prefix + body, dtype=np.uint8)
        starts, _ = chunk_dedup.cuts(data, np.array([0, len(data)]))
        own = set((starts[starts >= len(prefix) + 64] - len(prefix)).tolist())
        assert own == {s for s in chunk_dedup.cuts(np.frombuffer(body, dtype=np.uint8), np.array([0, len(body)]))[0].tolist() if s >= 64}
    # A text is cut the same whatever lies beside it.
    other = words(rng, 50).encode()
    both = np.frombuffer(other + body, dtype=np.uint8)
    starts, _ = chunk_dedup.cuts(both, np.array([0, len(other), len(both)]))
    assert (starts[starts >= len(other)] - len(other)).tolist() == chunk_dedup.cuts(np.frombuffer(body, dtype=np.uint8), np.array([0, len(body)]))[0].tolist()


def test_rolling_hash_equals_its_definition():
    """A word begins a chunk if the gear sum of the 32 bytes before it has two upper bits 0."""
    rng = random.Random(3)
    data = words(rng, 300).encode()
    gear = chunk_dedup._GEAR.tolist()
    want = [0]
    for at in range(1, len(data)):
        if data[at - 1 : at] == b" ":
            sum_ = 0
            for byte in (bytes(chunk_dedup.WINDOW) + data)[at : at + chunk_dedup.WINDOW]:
                sum_ = (2 * sum_ + gear[byte]) % 2**32
            if sum_ >> (32 - chunk_dedup.WORD_RATE) == 0:
                want.append(at)
    assert chunk_dedup.cuts(np.frombuffer(data, dtype=np.uint8), np.array([0, len(data)]))[0].tolist() == want


@pytest.mark.parametrize("joint", ["", "。"])
def test_scripts_without_blanks(spark, joint):
    rng = random.Random(4)
    some = lambda n: joint.join(chr(rng.randint(0x4E00, 0x9FA0)) for _ in range(n))
    passage = some(1500)
    rows = [(1, some(400) + passage + some(300)), (2, some(500) + passage), (3, some(3000))]
    spans = chunk_dedup.repeated_spans(frame(spark, rows)).collect()
    assert {r.doc_id for r in spans} == {2}
    assert sum(r.end - r.start for r in spans) > 0.7 * len(passage.encode())
    for r in spans:
        dict(rows)[2].encode()[r.start : r.end].decode()  # whole characters


@pytest.mark.parametrize("first, last", [(0x4E00, 0x9FA0), (0x3041, 0x3096), (0x0E01, 0x0E2E), (0x1780, 0x17B3)])
def test_short_passages_in_scripts_without_blanks(spark, first, last):
    """Passages of 100 characters, some fifty words, in texts with and without a blank now and then."""
    rng = random.Random(first)
    some = lambda n: "".join(chr(rng.randint(first, last)) for _ in range(n))
    rows, passages = [], {}
    for k in range(0, 200, 2):
        passage = some(100) if k % 4 else " ".join(some(20) for _ in range(5))
        passages[k + 1] = passage
        rows += [(k + i, some(rng.randint(30, 200)) + passage + some(rng.randint(30, 200))) for i in range(2)]
    rows += [(1000 + k, some(400)) for k in range(40)]
    texts = dict(rows)
    spans = chunk_dedup.repeated_spans(frame(spark, rows)).collect()
    found = {r.doc_id for r in spans}
    assert found <= set(passages) and len(found) >= 0.97 * len(passages)
    for r in spans:
        cut = texts[r.doc_id].encode()[r.start : r.end].decode()
        assert cut in passages[r.doc_id] and abs(len(cut.replace(" ", "")) / 2 - r.words) <= 1
    assert sum(len(texts[r.doc_id].encode()[r.start : r.end].decode()) for r in spans) > 0.7 * sum(map(len, passages.values()))


def test_chunks_of_unrelated_documents_are_not_stitched(spark):
    """Of a small vocabulary, short chunks are in many documents; what is cut repeats as stretches of 12 words."""
    rng = random.Random(6)
    vocabulary = [words(rng, 1) for _ in range(30)]
    some = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    passage = some(60)
    rows = [(k, some(60)) for k in range(400)] + [(1000, f"{some(30)} {passage} {some(30)}"), (1001, f"{some(30)} {passage} {some(30)}")]
    texts = dict(rows)
    found = chunk_dedup.repeated_spans(frame(spark, rows)).collect()
    assert 1001 in {r.doc_id for r in found}
    for r in found:
        cut = texts[r.doc_id].encode()[r.start : r.end].decode().split()
        held = [f" {texts[k]} " for k in r.kept_in]
        covered = set()
        for i in range(len(cut) - chunk_dedup.MIN_WORDS + 1):
            if any(f" {' '.join(cut[i : i + chunk_dedup.MIN_WORDS])} " in t for t in held):
                covered.update(range(i, i + chunk_dedup.MIN_WORDS))
        assert covered == set(range(len(cut)))


def test_odd_rows(spark):
    rng = random.Random(5)
    text = words(rng, 200)
    rows = [(1, text), (1, text), (2, text), (3, None), (4, ""), (None, text), (5, "short text"), (6, "short text"), (7, f"{text}\n{text}"), (8, "a" * 300_000), (9, "a" * 300_000)]
    found = {r.doc_id for r in chunk_dedup.repeated_spans(frame(spark, rows)).collect()}
    assert found == {2, 7, 9}
    left = chunk_dedup.without_repeats(frame(spark, rows))
    assert left.columns == ["doc_id", "text", "start", "words"]
    got = sorted(((r.doc_id, r.text) for r in left.collect()), key=str)
    kept = {k: t for k, t in rows} | {2: "", 9: ""}
    assert [x for x in got if x[0] != 7] == sorted(((k, kept[k]) for k, _ in rows if k != 7), key=str)
    assert len(dict(x for x in got if x[0] is not None)[7]) < 150
    empty = frame(spark, rows).limit(0)
    assert chunk_dedup.repeated_spans(empty).collect() == [] and chunk_dedup.without_repeats(empty).collect() == []


def plain_spans(texts, min_words=chunk_dedup.MIN_WORDS):
    """{(document, start, end, words, documents of first copies)} by the texts of all windows themselves."""
    inner, windows = chunk_dedup.INNER, {}
    placed = []
    for key, text in sorted(texts.items()):
        data = (text or "").encode()
        if not data:
            continue
        array = np.frombuffer(data, dtype=np.uint8)
        starts, at = chunk_dedup.cuts(array, np.array([0, len(data)]))
        dense = set(np.flatnonzero(chunk_dedup.dense(array)).tolist())
        edges = [*starts.tolist(), len(data)]
        weights = []  # of each chunk, in parts of a word
        for a, b in zip(edges[:-1], edges[1:]):
            said = sum(inner for w in at.tolist() if a <= w < b and w not in dense) + sum(inner // 2 for d in dense if a <= d < b)
            weights.append(max(said, b - a))
        for i, a in enumerate(edges[:-1]):
            total, j = 0, i
            while j < len(weights) and total < min_words * inner:
                total, j = total + weights[j], j + 1
            if total >= min_words * inner:
                before = sum(weights[:i])
                placed.append((key, a, edges[j], before // inner, (before + total) // inner, data[a : edges[j]]))
                windows.setdefault(placed[-1][-1], []).append(key)
    out, seen = [], set()
    for key, a, b, before, after, said in placed:  # by document and place
        if len(windows[said]) > 1 and (windows[said][0] != key or (key, said) in seen):
            first = windows[said][0]
            if out and out[-1][0] == key and a <= out[-1][2]:
                out[-1][2], out[-1][4] = max(b, out[-1][2]), max(after, out[-1][4])
                out[-1][5].add(first)
            else:
                out.append([key, a, b, before, after, {first}])
        seen.add((key, said))
    return {(k, a, b, after - before, tuple(sorted(firsts))) for k, a, b, before, after, firsts in out}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equals_all_windows(spark, seed):
    """Every window of every text against every other, on texts that share passages in many ways."""
    rng = random.Random(seed)
    shared = [words(rng, rng.randint(5, 40), "abc") for _ in range(12)] + ["日本語の文章を" * 12, "x" * 900]
    texts = {}
    for k in range(80):
        parts = [rng.choice(shared) if rng.random() < 0.5 else words(rng, rng.randint(0, 20), "abcde") for _ in range(rng.randint(0, 6))]
        texts[k * 3] = rng.choice([" ", "\n", ""]).join(parts)
    texts |= {500: texts[3], 501: texts[3] * 3, 502: "", 503: None}
    got = {(r.doc_id, r.start, r.end, r.words, tuple(r.kept_in)) for r in chunk_dedup.repeated_spans(frame(spark, list(texts.items()))).collect()}
    want = plain_spans(texts)
    assert got == want and len(want) > 20


def test_documents_equal_all_windows(spark, sf):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = {(r.doc_id, r.start, r.end, r.words, tuple(r.kept_in)) for r in chunk_dedup.repeated_spans(spark.read.parquet(f"{sf}/documents.parquet")).collect()}
    assert got == plain_spans(texts)
