"""Byte BPE against the tokenizers library."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

tokenizers = pytest.importorskip("tokenizers")
public_tokenizers = pytest.importorskip("public_tokenizers")

from marquee.llm import bpe  # noqa: E402

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = [
    "",
    " ",
    "  two  blanks\t\ttabs \n\n lines ",
    "it's we've I'LL don't",
    "<|endoftext|>a<|endoftext|> <|endoftext|>",
    "x" * 300 + "-" * 300,
    "é" * 100 + "ñandú ß 10½ ²",
    "a\x85b\x1cc d",
    "🙂👩‍👩‍👧 \U0001e6c0\U0001e6c1 ՘word՘",
    "0x1F 3.14159 1234567890123",
]


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def codec(spark):
    return bpe.Codec.load(spark, PATH)


def test_odd_texts_and_extra_columns(spark, codec, library):
    rows = [(i, t, "x", [1]) for i, t in enumerate([*ODD, *ODD[:2], None])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string, token_ids array<int>")
    out = docs.select("doc_id", "text", codec.encode(F.col("text")).alias("t")).withColumn("back", codec.decode(F.col("t")))
    for row in out.collect():
        want = library.encode(row.text or "", add_special_tokens=False).ids
        assert row.t == want
        assert row.back == library.decode(want, skip_special_tokens=False) == (row.text or "")


def test_an_empty_table_and_null_ids(spark, codec):
    empty = spark.createDataFrame([], "text string")
    assert empty.select(codec.encode(F.col("text"))).collect() == []
    none = spark.createDataFrame([(None,), ([],)], "ids array<int>").select(codec.decode(F.col("ids")).alias("t")).collect()
    assert [r.t for r in none] == [None, ""]


def test_scanning_and_the_heap_merge_alike():
    vocabulary = bpe.Vocabulary.load(PATH)
    draw = random.Random(5)
    words = [bytes(draw.choice(b"aehinrst  \xc3\xa9") for _ in range(draw.randint(1, bpe.SHORT_WORD))) for _ in range(400)]
    for word, packed in zip(words, bpe.merge_short(words, vocabulary)):
        assert np.frombuffer(packed, np.int32).tolist() == bpe.merge_long(word, vocabulary)


def test_a_very_long_text_is_cut_between_words(library, monkeypatch):
    monkeypatch.setattr(bpe, "STRETCH", 200)
    monkeypatch.setattr(bpe, "KEPT_WORDS", 50)
    vocabulary, draw = bpe.Vocabulary.load(PATH), random.Random(7)
    text = "".join(draw.choice(["word", " ", "  ", "'s", " the", "\n", "12", " ,", "."]) for _ in range(5000))
    (packed,) = bpe.Encoder(vocabulary).packed([text])
    assert np.frombuffer(packed, np.int32).tolist() == library.encode(text, add_special_tokens=False).ids
    assert "".join(bpe.stretches(text)) == text


def test_query_against_the_library(spark, library):
    from marquee.llm.queries import QUERIES
    import hashlib

    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    rows = QUERIES["op4_bpe"](spark, folder).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256) == (len(ids), digest(",".join(map(str, ids))))
        assert r.decoded_sha256 == digest(library.decode(ids, skip_special_tokens=False))
