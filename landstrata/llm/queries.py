"""One query for each operator, over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from landstrata.llm import bpe, check_sql, chunk_dedup, fim, langid, licences, lm_score, minhash, ngram_join, packing, pii, prefix_trie, search, secrets

# Key of the surrogates in the registered query; a real run brings its own.
SURROGATE_KEY = "landstrata"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def registered(make: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[make.__name__] = make
    return make


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def tokenizer(name: str) -> str:
    """The file of a public tokenizer; it is read on the workers, which have the same installation."""
    import public_tokenizers

    return public_tokenizers.path(name)


@registered
def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), tokenizer("byte_bpe_50k.json"))


@registered
def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.component_ids(documents(spark, sf_dir), width=4, threshold=(85, 100))


@registered
def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_dedup.repeated_spans(documents(spark, sf_dir))


@registered
def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(documents(spark, sf_dir))


def document_path() -> Column:
    """Where a document would lie in a sharded tree: its source, its number's leading pairs of digits. The
    first of a directory is its licence file."""
    pairs = F.regexp_replace(F.expr("cast(doc_id div 100 as string)"), r"(\d\d)(?=\d)", "$1/")
    name = F.when(F.col("doc_id") % 100 == 0, F.lit("LICENSE")).otherwise(F.concat(F.col("doc_id").cast("string"), F.lit(".txt")))
    return F.concat_ws("/", F.coalesce("source", F.lit("unknown")), F.when(F.col("doc_id") >= 100, pairs), name)


@registered
def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.licences(documents(spark, sf_dir), document_path())


@registered
def op6_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.replaced(documents(spark, sf_dir).select("doc_id", "text"), SURROGATE_KEY)


@registered
def op7_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.edited_likeness(documents(spark, sf_dir))


@registered
def op8_exact_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents for the whole text, all its terms, of every document whose id is divisible by 100."""
    docs = documents(spark, sf_dir)
    df, n, mean = search.statistics(docs)
    return search.search(docs, search.telling_terms(docs.where("doc_id % 100 = 0"), df, n, terms=None), mean)


@registered
def op9_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_digests(documents(spark, sf_dir), tokenizer("word_bpe_49k.json"))


@registered
def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = langid.learn(docs.where(~langid.held_out()))
    return langid.predict(docs.select("doc_id", "text", langid.held_out().alias("held_out")), model).drop("text")


@registered
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    found = prefix_trie.trie(prefix_trie.rebuilt(prefix_trie.turns(given)), given.select("conv_id"))
    nothing = F.sha2(F.lit(b""), 256)
    named = found.nodes.join(prefix_trie.end_digests(found.ends), prefix_trie.NODE, "left")
    return named.withColumn("ends_sha256", F.coalesce("ends_sha256", nothing)).drop("x", "y")


@registered
def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    changed = fim.restored(fim.rearranged(documents(spark, sf_dir)))
    digests = [F.sha2(F.col(c).cast("binary"), 256).alias(f"{c}_sha256") for c in ("output", "restored")]
    return changed.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


@registered
def op13_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learned from the documents that are not held out; a null id counts as no digits."""
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 7 == 2
    scored = lm_score.score(documents(spark, sf_dir), ~held_out)
    return scored.withColumn("held_out", ~F.col("learns")).drop("learns")


# The others have no SQL: tokenizers, rolling hashes, keyed digests, sketches and learned models. Tests
# compare them with brute-force versions, the library's own results, or held-out labels.
SQL["op2_ngram_jaccard_join"] = check_sql.component_ids(4, (85, 100))
SQL["op5_license_scan"] = check_sql.license_scan()
SQL["op11_prefix_trie"] = check_sql.prefix_trie()
SQL["op12_fill_in_middle"] = check_sql.fill_in_middle()
