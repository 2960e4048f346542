import random

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallyspark.llm import bpe

LIBRARY = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
CODEC = bpe.codec("byte_bpe_50k", None)
ALPHABET = "aab e'’rsSt  \n\t\r12.,!?éüß 中文١०ǅⅧ½ª\x85\u2003\u00a0\u200d😀"
texts = st.lists(st.one_of(st.text(ALPHABET, max_size=12), st.text(max_size=6), st.sampled_from(
    ["<|endoftext|>", "<|endof", "text|>", "'re", " 've", "  ", "\n\n ", "the", " theater"])), max_size=12).map("".join)


def ids_of(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


@settings(max_examples=400, deadline=None)
@given(texts)
def test_encode_equals_library(text):
    assert CODEC.encode(text) == ids_of(text)
    ids = ids_of(text)
    assert bpe.text_of(CODEC.bytes_of, ids) == LIBRARY.decode(ids, skip_special_tokens=False) == text


@settings(max_examples=1500, deadline=None)
@given(texts, texts)
def test_join_equals_whole(a, b):
    a, b = a.replace("<|endoftext|>", "x"), b.replace("<|endoftext|>", "x")
    node = lambda t: tuple(map(np.asarray, CODEC.encode_marked(t)))
    if a and b and "<|endoftext|>" not in a + b:
        ids, starts = CODEC.join(node(a), node(b))
        whole = node(a + b)
        assert ids.tolist() == whole[0].tolist() and starts.tolist() == whole[1].tolist()
        assert ids.tolist() == ids_of(a + b)


@settings(max_examples=300, deadline=None)
@given(st.text("abcehinorst", min_size=1, max_size=60), st.text("abcehinorst", min_size=1, max_size=60))
def test_join_inside_a_long_piece(a, b):
    long = bpe.Codec.LONG
    try:
        bpe.Codec.LONG = 4
        node = lambda t: tuple(map(np.asarray, CODEC.encode_marked(t)))
        assert CODEC.join(node("so " + a), node(b + " it"))[0].tolist() == ids_of("so " + a + b + " it")
        assert CODEC.join(node(a), node(b))[0].tolist() == ids_of(a + b)
    finally:
        bpe.Codec.LONG = long


def test_documents(spark):
    rng = random.Random(1)
    words = ["the", " of", "tion", "'re", "\n", "  ", " 中文", "<|endoftext|>", "é", "123", " .", "aaaaaaa"]
    rows = [(None, None, 1), (1, "", 2), (1, "", 2), (2, None, 3), (3, "<|endoftext|>" * 3, 4)]
    rows += [(i, "".join(rng.choice(words) for _ in range(rng.randrange(400))), i) for i in range(10, 40)]
    rows += [(50, "x" * 700 + "ab" * 300, 0), (51, "tion" * 400, 0), (52, rows[-1][1], 0), (None, rows[-1][1], 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids_ int").withColumn("KEY", F.lit(1)).withColumn("text_key", F.lit("x"))
    out = bpe.decode(bpe.encode(docs, leaf=64), out="back").collect()
    assert sorted((r.doc_id or -1, r.text or "") for r in out) == sorted((r[0] or -1, r[1] or "") for r in rows)
    for r in out:
        assert np.frombuffer(r.ids, "<u4").tolist() == ids_of(r.text or "")
        assert r.back == (r.text or "")


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.decode(bpe.encode(docs)).collect() == []


def test_decode_invalid_ids(spark):
    ids = [CODEC.bytes_of.index(b"\xc3"), 50256, CODEC.bytes_of.index(b"a")]
    df = spark.createDataFrame([(np.asarray(ids, "<u4").tobytes(),), (None,)], "ids binary")
    got = {r.decoded for r in bpe.decode(df).collect()}
    assert got == {LIBRARY.decode(ids, skip_special_tokens=False), ""}


@pytest.mark.parametrize("leaf", [200, 5000])
def test_query_table(spark, leaf):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    for r in bpe.encode(docs, leaf=leaf).collect():
        assert np.frombuffer(r.ids, "<u4").tolist() == ids_of(r.text)
