import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from landstrata.llm import langid


def test_held_out_accuracy(spark, sf):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.learn(docs.where(~langid.held_out()))
    assert model.languages == ["de", "en", "es", "fr"]
    rows = langid.predict(docs.withColumn("held_out", langid.held_out()), model).where("held_out").collect()
    assert len(rows) > 150 and all(0 <= r.score <= 1 for r in rows)
    assert sum(r.lang_pred == r.lang for r in rows) / len(rows) > 0.97


def test_predictions_look_at_the_text_only(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = langid.learn(docs)
    first = {r.doc_id: (r.lang_pred, r.score) for r in langid.predict(docs, model).collect()}
    other = docs.withColumns({"lang": F.lit("xx"), "source": F.lit("y")}).repartition(7)
    assert {r.doc_id: (r.lang_pred, r.score) for r in langid.predict(other, model).collect()} == first


def test_odd_rows(spark):
    learned = spark.createDataFrame([("aab bba", "x"), ("ccd ddc", "y"), (None, "x"), ("zz", None), ("", "y")], "text string, lang string")
    model = langid.learn(learned)
    assert model.languages == ["x", "y"] and np.allclose(np.exp(model.prior), [1 / 3, 2 / 3])
    rows = [(1, "AAB abab", "q"), (2, "dcdc", "q"), (3, None, "q"), (4, "", "q"), (5, "12 ?!", "q"), (None, "ccc", "q"), (6, "dd " * 600_000, "q"), (2, "dcdc", "q")]
    df = spark.createDataFrame(rows, "doc_id long, text string, score string")
    out = langid.predict(df, model)
    assert out.columns == ["doc_id", "text", "lang_pred", "score"]
    got = sorted(((r.doc_id, r.lang_pred, r.score > 0.5) for r in out.collect()), key=str)
    assert got == sorted([(1, "x", True), (2, "y", True), (2, "y", True), (3, "und", False), (4, "und", False), (5, "und", False), (None, "y", True), (6, "y", True)], key=str)
    unknown = langid.learn(learned.limit(0))
    assert unknown.languages == [] and {(r.lang_pred, r.score) for r in langid.predict(df, unknown).collect()} == {("und", 0.0)}
    assert langid.predict(df.limit(0), model).collect() == []


@pytest.mark.parametrize("piece", [langid.PIECE, 7])
def test_ngrams_are_those_of_the_text(monkeypatch, piece):
    """Cutting long texts into pieces neither loses an n-gram nor makes one."""
    monkeypatch.setattr(langid, "PIECE", piece)
    rng = random.Random(1)
    texts = ["".join(rng.choice("ab É1.\0日") for _ in range(rng.randint(0, 50))) for _ in range(60)] + [None]
    got = [0] * len(texts)
    for numbers, bounds, _ in langid.ngrams(texts):
        for k, n in zip(numbers.tolist(), np.diff(bounds).tolist()):
            got[k] += n
    for k, text in enumerate(texts):
        t = (text or "").lower()
        grams = [t[i : i + n] for n in langid.SIZES for i in range(len(t) - n + 1)]
        assert got[k] == sum(any(c.isalpha() for c in g) for g in grams)


def test_scores_equal_a_plain_evaluation(spark):
    """One bucket a letter would do: sums of log probabilities plus the prior, made into shares."""
    learned = spark.createDataFrame([("ab", "x"), ("bc", "y")], "text string, lang string")
    model = langid.learn(learned)
    sums = model.prior.copy()
    for _, _, buckets in langid.ngrams(["abc"]):
        sums = sums + model.weights[buckets].sum(axis=0)
    want = np.exp(sums - sums.max())
    (row,) = langid.predict(spark.createDataFrame([("abc",)], "text string"), model).collect()
    assert row.score == pytest.approx(want.max() / want.sum())
