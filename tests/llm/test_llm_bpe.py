"""Ids and decoded texts against the tokenizers library."""

import hashlib
import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from hammerline.llm import bpe
from hammerline.llm.queries import QUERIES

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_round_trip_matches_library(spark, sf, library):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op9_bpe_round_trip"](spark, sf).collect()}
    for i, text in texts.items():
        ids = library.encode(text, add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert got[i] == (len(ids), sha(",".join(map(str, ids))), sha(decoded))


def test_any_text(library):
    random.seed(4)
    letters = list("aaabbb  \n\t'sdtré€😀  \x1c\x85İ１²_-,.!129") + ["<|endoftext|>", "the ", "'ll", "\r\n"]
    texts = ["".join(random.choice(letters) for _ in range(random.randint(0, 60))) for _ in range(3000)]
    texts += ["a" * 9001, " " * 3000, "ab" * 5000, "", "<|endoftext|>", "x" * 300 + " y"]
    encoder = bpe.Encoder(bpe.Vocabulary(PATH))
    for _ in range(2):  # with and without remembered pieces
        for text, ids in zip(texts, encoder.encode_all(texts)):
            assert ids.tolist() == library.encode(text, add_special_tokens=False).ids
            assert bpe.decode_one(ids, encoder.vocabulary.tokens) == text


def test_columns_and_edges(spark, library):
    long_text = "Wörter und noch mehr " * 40_000
    rows = [(1, None, 1), (1, None, 1), (2, "", 2), (None, "a b", 3), (4, long_text, 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    out = docs.select("doc_id", bpe.encode(F.col("text"), PATH).alias("ids"))
    out = out.select("doc_id", "ids", bpe.decode(F.col("ids"), PATH).alias("back")).collect()
    for (i, text, _), r in zip(rows, out):
        assert r.doc_id == i and r.back == (text or "")
        assert r.ids == library.encode(text or "", add_special_tokens=False).ids
    trip = bpe.round_trip(docs, PATH)
    assert trip.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert [r.n_tokens for r in trip.collect()] == [len(r.ids) for r in out]
    assert bpe.round_trip(docs.limit(0), PATH).count() == 0
