import hashlib
import random

import numpy as np
from tokenizers import Tokenizer

import public_tokenizers
from landstrata.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "", "'s it's I'LL we're 'S ''s 'll've", "a  b\n\n c d　e", "<|endoftext|>hi<|startoftext|> <|endoftext|", "ΣΑΣ ΟΔΟΣ İstanbul", "été é ñ 12³½ Ⅷ ٣",
    "日本語 テスト 한국어 ไทย", "x" * 300, "😀👍🏽 a​b﻿ \x00\x1f\x85", "don't y'all o'clock 'tis rock'n'roll 'd", "<", "<|endoftext|>" * 3, "ß ẞ ﬁ ǅ",
]


def want(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    decoded = library.decode(ids, skip_special_tokens=False)
    return len(ids), hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()


def test_encodes_and_decodes_as_the_library(spark, sf):
    library = Tokenizer.from_file(PATH)
    rng = random.Random(4)
    texts = ODD + ["".join(rng.choice(" '\nabT1.é'srtvlÄ²<|>") for _ in range(rng.randint(1, 60))) for _ in range(1500)] + [None, "word's " * 80_000]
    texts += [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    for r in bpe.encode_digests(df, PATH).collect():
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == want(library, texts[r.doc_id]), texts[r.doc_id]


def test_round_trip_tables(spark):
    library = Tokenizer.from_file(PATH)
    df = spark.createDataFrame([(1, "Hello  World 12", "c"), (2, None, "c"), (2, None, "c"), (None, "a<|endoftext|>", "c")], "doc_id int, text string, ids string")
    rows = bpe.encode(df, PATH)
    got = {(r.doc_id, tuple(r.ids)) for r in rows.collect()}
    assert got == {(1, tuple(library.encode("Hello  World 12").ids)), (2, ()), (None, tuple(library.encode("a<|endoftext|>").ids))}
    texts = {r.doc_id: r.text for r in bpe.decode(rows, PATH).collect()}
    assert texts == {1: "hello</w> world</w> 1</w> 2</w>", 2: "", None: "a</w> <|endoftext|>"}
    assert bpe.encode_digests(df.limit(0), PATH).collect() == []


def test_small_memory_and_stale_merges():
    """A memory for few words is emptied and filled again without changing a result."""
    known = bpe.Vocabulary(PATH)
    known.words.remembered = 40
    library = Tokenizer.from_file(PATH)
    rng = random.Random(9)
    texts = [" ".join("".join(rng.choice("etaoin") for _ in range(rng.randint(1, 30))) for _ in range(30)) for _ in range(40)]
    for text in texts:
        ids = [k for _, own, _ in known.encoded([text]) for k in own.tolist()]
        assert ids == library.encode(text).ids
