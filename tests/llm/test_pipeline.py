import re
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
import public_tokenizers
from landstrata.llm import chunk_dedup, langid, queries

sys.path.insert(0, str(Path(__file__).resolve().parent))
import brute  # noqa: E402
from test_packing import check  # noqa: E402

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_registered():
    names = [q for q in entry.queries() if re.match(r"op\d+_", q)]
    assert sorted(int(re.match(r"op(\d+)", q)[1]) for q in names) == list(range(1, 14))
    assert entry.queries()["pipeline"] is corpus_pipeline.run and set(queries.QUERIES) <= set(entry.queries())
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "ngram_jaccard_join", "substring_dedup", "pii", "best_fit_packing"]


def test_stages_against_plain_evaluations(spark, sf):
    """Every stage on what the one before it kept, and the whole run."""
    docs = queries.documents(spark, sf).unionByName(
        spark.createDataFrame([(900, "12 34 ?!", "en", "s", 8), (901, None, None, None, None), (902, "", "en", "s", 0)], queries.documents(spark, sf).schema)
    )
    kept = []
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf)
        kept.append((docs.collect(), out.collect()))
        docs = out
        if len(kept) < len(corpus_pipeline.STAGES):
            assert out.columns == COLUMNS

    before, after = kept[0]
    assert {r.doc_id for r in before} - {r.doc_id for r in after} == {900, 901, 902}
    assert {tuple(r) for r in after} <= {tuple(r) for r in before}

    before, after = kept[1]
    linked = brute.groups({r.doc_id: r.text for r in before}, 5, 80, 100)
    assert {r.doc_id for r in after} == {k for k, (_, c) in linked.items() if k == c} and len(after) < len(before)

    before, after = ({r.doc_id: r for r in rows} for rows in kept[2])
    assert set(before) == set(after)
    spans = {}
    frame = spark.createDataFrame(list(before.values()))
    for r in chunk_dedup.repeated_spans(frame).collect():
        spans.setdefault(r.doc_id, []).append((r.start, r.end))
    for key, row in before.items():
        data = row.text.encode()
        for a, b in sorted(spans.get(key, []), reverse=True):
            data = data[:a] + data[b:]
        assert after[key].text == data.decode() and after[key].n_chars == len(after[key].text)

    before, after = ({r.doc_id: r for r in rows} for rows in kept[3])
    value = re.compile(r"[\w.]+@[\w.]+\w|\+1 \(\d{3}\) \d{3}-\d{4}|(?<!\d)\d{16}(?!\d)|(?<![\d.])\d+\.\d+\.\d+\.\d+")
    assert set(before) == set(after)
    for key, row in before.items():
        assert (after[key].text == row.text) == (not value.search(row.text)) and after[key].n_chars == len(after[key].text)

    before, after = kept[4]
    check(after, {r.doc_id: r.text for r in before})


def test_repeated_rows_are_kept_once(spark, sf):
    docs = queries.documents(spark, sf).where("doc_id < 40")
    odd = spark.createDataFrame([(None, "one two three four five six", "en", "s", 27), (901, "", "en", "s", 0), (902, None, "en", "s", None)], docs.schema)
    rows = docs.unionByName(odd)
    twice = rows.unionByName(rows).unionByName(docs.where("doc_id < 5"))
    once = corpus_pipeline.drop_near_copies(spark, rows, sf).collect()
    got = corpus_pipeline.drop_near_copies(spark, twice, sf).collect()
    assert sorted(map(tuple, (r for r in got if r.doc_id is not None)), key=str) == sorted(map(tuple, (r for r in once if r.doc_id is not None)), key=str)
    assert sum(r.doc_id is None for r in got) == 2 and sum(r.doc_id is None for r in once) == 1 and {901, 902} <= {r.doc_id for r in got}


def test_run(spark, sf):
    out = corpus_pipeline.run(spark, sf)
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert out.select("doc_id").distinct().count() > 100


@pytest.mark.parametrize("name", sorted(n for n in queries.QUERIES))
def test_queries_run_over_whole_tables(spark, sf, name):
    out = queries.QUERIES[name](spark, sf)
    plan = spark._jvm.PythonSQLUtils.explainString(out._jdf.queryExecution(), "formatted")
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin|BatchEvalPython", plan)
    if name in ("op5_license_scan", "op6_pii_surrogates", "op7_document_fingerprints"):
        assert not re.search("Python|Pandas|Arrow", plan)
    if name not in ("op3_substring_dedup", "op8_exact_topk_search", "op11_prefix_trie"):
        assert out.select("doc_id").distinct().count() == queries.documents(spark, sf).count()


def test_clean_documents_stay(spark):
    """Language ID at the stage's threshold keeps every document of the table; junk without letters goes."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    kept = corpus_pipeline.identify_languages(spark, docs, "")
    assert kept.count() == docs.count()
    assert langid.UNKNOWN not in {r.lang for r in docs.select("lang").distinct().collect()}
    assert kept.where(F.col("text").isNull()).isEmpty() and public_tokenizers.path("byte_bpe_50k.json")


def test_stages_leave_other_columns_alone(spark, sf):
    """Names that operators use themselves, whole rows repeated, and an empty table."""
    names = ["score", "lang_pred", "n_email", "given", "spans", "__key", "__row", "row", "said", "copy", "digest", "n"]
    docs = queries.documents(spark, sf).where("doc_id < 60").withColumns({n: F.lit(7.0 + k) for k, n in enumerate(names)})
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs.limit(0), sf).collect() == []
        out = stage(spark, docs.unionByName(docs), sf)
        assert out.columns == docs.columns
        assert out.select(*names).distinct().collect() == [tuple(7.0 + k for k in range(len(names)))]
