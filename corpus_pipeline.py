"""A corpus pipeline over `documents`: each stage's result is written as Parquet and is the next one's input."""

from __future__ import annotations

import sys
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from landstrata.llm import chunk_dedup, langid, ngram_join, packing, pii  # noqa: E402
from landstrata.llm.queries import SURROGATE_KEY, documents, tokenizer  # noqa: E402
from landstrata.session import fresh_folder, materialise, small_side  # noqa: E402

LEAST_SCORE = 0.5  # a language less likely than all others together is not accepted


def with_lengths(docs: DataFrame, columns: list[str]) -> DataFrame:
    """`docs` after a change of its texts, in the order of `columns` and with `n_chars` counted anew."""
    return docs.withColumn("n_chars", F.char_length("text").cast("bigint")).select(*columns)


def nested(docs: DataFrame) -> DataFrame:
    """The texts, and all other columns in one, so that columns which an operator adds replace none."""
    return docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns if c != "text")).alias("given"), "text")


def unnested(docs: DataFrame, columns: list[str]) -> DataFrame:
    return docs.select(*(F.col("text") if c == "text" else F.col("given").getField(c).alias(c) for c in columns))


def identify_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leaves out documents without a letter, and those whose language is not told with enough certainty.

    Null and empty texts have no letter. Documents are judged one by one: repeated rows stay or go
    together, whatever their keys. Without any labelled document no language is known and all go.
    """
    model = langid.learn(docs.where(~langid.held_out()))
    found = langid.predict(nested(docs), model)
    return unnested(found.where((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= LEAST_SCORE)), docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked ones stays, that of the smallest id; links at five words and 0.8.

    A document that is repeated as a whole row is kept once; one without an id or without words stays.
    """
    copies = ngram_join.component_ids(docs).where("doc_id <> component_id").select("doc_id").distinct()
    copies = materialise(copies.withColumn("copy", F.lit(True)))
    # Only rows whose id is there again are compared as a whole.
    repeated = docs.where("doc_id is not null").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("doc_id")
    repeated = repeated.join(copies, "doc_id", "left_anti").withColumn("copy", F.lit(False))
    apart, _ = small_side(copies.unionByName(repeated))
    kept = docs.join(apart, "doc_id", "left_anti").select(*docs.columns)
    again = docs.join(apart.where("not copy"), "doc_id", "left_semi").select(*docs.columns).dropDuplicates()
    return kept.unionByName(again)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that occur before are cut out of the texts, of which all rows stay.

    A passage stays where the document of the smallest id has it first. Null texts and rows without an
    id stay as they are; a text may become empty. Empty tables stay empty.
    """
    return with_lengths(chunk_dedup.without_repeats(docs), docs.columns)


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data give way to surrogates; all rows stay, null and empty texts as they are."""
    return with_lengths(unnested(pii.replaced(nested(docs), SURROGATE_KEY), docs.columns), docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The places of all documents' tokens in sequences of 1024. Null and empty texts hold the end token
    only; repeated rows are packed each by itself; an empty table gives an empty result."""
    return packing.pack(docs, tokenizer("byte_bpe_50k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", identify_languages),
    ("ngram_jaccard_join", drop_near_copies),
    ("substring_dedup", cut_repeats),
    ("pii", replace_personal_data),
    ("best_fit_packing", pack_sequences),
]

# No SQL: language ID, rolling hashes and tokenizers have none. Tests compare with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; what each keeps is written to the shared folder and read again."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        path = fresh_folder(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
