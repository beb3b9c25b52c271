import hashlib
import re

from landstrata.llm import minhash


def shingle_set(text):
    words = [w for w in re.split("[ \t-\r]+", text.lower()) if w]
    return {tuple(words[i : i + minhash.WIDTH]) for i in range(max(1, len(words) - minhash.WIDTH + 1))} if words else set()


def test_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = minhash.edited_likeness(docs.repartition(5))
    plan = spark._jvm.PythonSQLUtils.explainString(out._jdf.queryExecution(), "formatted")
    assert not re.search("Python|Pandas|Arrow|CartesianProduct|NestedLoop", plan)
    texts = {r.doc_id: r.text for r in docs.collect()}
    order = sorted(texts)
    after = dict(zip(order, order[1:] + order[:1]))
    errors, prints = [], {}
    rows = out.collect()
    assert {r.doc_id for r in rows} == set(texts) and len(rows) == len(texts)
    for r in rows:
        text, following = texts[r.doc_id], texts[after[r.doc_id]]
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        own = shingle_set(text)
        for near, other in ((r.near_edited, shingle_set(edited)), (r.near_next, shingle_set(following))):
            assert 0 <= near <= 1
            errors.append(near - len(own & other) / len(own | other))
        assert prints.setdefault(text, r.fingerprint) == r.fingerprint
    # 256 bins: a standard error of 0.031 at most, and no bias.
    assert abs(sum(errors) / len(errors)) < 0.005 and max(map(abs, errors)) < 0.16
    assert len(set(prints.values())) == len(prints)
    assert {len(p) for p in prints.values()} == {2 << minhash.BIN_BITS}


def test_odd_rows(spark):
    schema = "doc_id long, text string, signature string, edited int"
    rows = [(1, None), (2, ""), (2, ""), (5, "one two"), (-7, "a b c d e f g " * 50), (None, "x"), (9, "one two"), (2**62, "w " * 200_000)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], schema)
    got = minhash.edited_likeness(df).collect()
    assert sorted(r.doc_id for r in got) == [-7, 1, 2, 2, 5, 9, 2**62]
    by = {r.doc_id: r for r in got}
    assert by[1].n_chars == 0 and by[1].fingerprint == "" and (by[1].near_edited, by[1].near_next) == (1.0, 1.0)
    assert by[5].fingerprint == by[9].fingerprint and by[5].near_next == 1.0 and by[-7].near_next == 0.0
    assert by[2**62].edited_sha256 == hashlib.sha256(("w " * 100_000 + ("a b c d e f g " * 50)[:200_000]).encode()).hexdigest()
    (alone,) = minhash.edited_likeness(df.where("doc_id = 5")).collect()
    assert alone.near_next == 1.0 and alone.edited_sha256 == hashlib.sha256(b"one one").hexdigest()
    assert minhash.edited_likeness(df.limit(0)).collect() == []
    assert {r.fingerprint for r in minhash.fingerprints(df.where("doc_id is null or doc_id = 1")).collect()} == {"", minhash.fingerprints(df.where("doc_id is null")).first().fingerprint}


def test_next_over_many_buckets(spark, monkeypatch):
    """Buckets of any sizes, with gaps and repeated keys."""
    for bucket in (1, 3, 50, 10_000):
        monkeypatch.setattr(minhash, "BUCKET", bucket)
        keys = [k * k for k in range(120)] + [100, 100, -5]
        df = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k long, v int").repartition(4)
        rows = minhash.with_next(df, "k", ["v"]).collect()
        order = sorted((k, i) for i, k in enumerate(keys))
        want = {a[1]: b[1] for a, b in zip(order, order[1:] + order[:1])}
        assert {r.v: r.next_v for r in rows} == want and len(rows) == len(keys)
