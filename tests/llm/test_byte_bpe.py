"""Byte-level BPE against the tiktoken library."""

import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from footfall.llm import byte_bpe, queries
from footfall.llm.common import ship_package

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
FOLDER = "/root/testdata/sf0.001"
with open(PATH, "rb") as source:
    RANKS = {base64.b64decode(t): int(r) for t, r in map(bytes.split, source)}
LIBRARY = tiktoken.Encoding(
    "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={}
)
TEXTS = [
    None, "", " ", "  ", "It's 12³ naïve  İx \n ΑΣ", "a\x1cb\x85c  d   e ", "<|endoftext|>x<|ENDOFTEXT|>",
    "漢字，漢" * 40, "x" * 300 + "ab" * 250, "the " * 150, "!!'s??'re" * 60, "é ́", "'s" * 200,
    " " * 400 + "w" + "\n" * 300, "a" * 130 + " " + "b" * 700, "👩‍👩‍👧 " * 50, "x\r\n\r\n y\t\tz " * 40,
]


@pytest.fixture(autouse=True)
def shipped(spark):
    ship_package(spark)


def docs(spark, texts, ids=None):
    rows = [(i, t, "clash", b"z") for i, t in zip(ids or range(len(texts)), texts, strict=True)]
    return spark.createDataFrame(rows, "doc_id long, text string, ids string, decoded binary")


def packed(text):
    return np.array(LIBRARY.encode_ordinary(text or ""), "<u4").tobytes()


@pytest.mark.parametrize(("chunk", "overlap"), [(60, 12), (61, 30), (200, 8), (1 << 16, 1 << 10)])
def test_ids_equal_the_library(spark, chunk, overlap):
    df = docs(spark, TEXTS)
    got = byte_bpe.decode(byte_bpe.encode(df, PATH, chunk=chunk, overlap=overlap), PATH).collect()
    assert len(got) == len(TEXTS)
    for row in got:
        assert row.ids == packed(TEXTS[row.doc_id]), TEXTS[row.doc_id]
        assert row.decoded == (TEXTS[row.doc_id] or "").encode()


def test_random_texts_in_small_chunks(spark):
    rng = random.Random(5)
    signs = "ab'st 1.\n  é漢"
    texts = ["".join(rng.choices(signs, k=rng.randrange(300))) for _ in range(150)]
    for row in byte_bpe.encode(docs(spark, texts), PATH, chunk=30, overlap=9).collect():
        assert row.ids == packed(texts[row.doc_id])


def test_very_long_texts(spark):
    rng = random.Random(6)
    prose = " ".join("".join(rng.choices("etaoin", k=rng.randrange(1, 9))) for _ in range(60_000))
    texts = [prose, "q" * 400_000, "k " + "z" * 150_000 + " end"]
    for row in byte_bpe.encode(docs(spark, texts), PATH).collect():
        assert row.ids == packed(texts[row.doc_id])


def test_every_plane_of_signs(spark):
    signs = [chr(c) for c in range(0x2FFF) if not 0xD800 <= c < 0xE000]
    texts = ["".join(f"xa{c}a  {c} 1{c}1!{c}! \n{c} " for c in signs[i : i + 500]) for i in range(0, len(signs), 500)]
    for row in byte_bpe.encode(docs(spark, texts), PATH).collect():
        assert row.ids == packed(texts[row.doc_id])


def test_repeated_rows_null_ids_and_empty_tables(spark):
    df = docs(spark, ["a b", "a b", "c"], ids=[1, 1, None])
    got = sorted((r.doc_id or 0, bytes(r.ids)) for r in byte_bpe.encode(df, PATH).collect())
    assert got == [(0, packed("c")), (1, packed("a b")), (1, packed("a b"))]
    assert byte_bpe.encode(docs(spark, []), PATH).count() == 0
    nulls = spark.createDataFrame([(1, None), (2, b"")], "doc_id int, ids binary")
    assert {r.doc_id: r.decoded for r in byte_bpe.decode(nulls, PATH).collect()} == {1: None, 2: b""}
    with pytest.raises(ValueError):
        byte_bpe.encode(df, PATH, chunk=10, overlap=10)


def test_query_equals_the_library(spark):
    given = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    found = queries.op12_byte_bpe(spark, FOLDER).collect()
    assert len(found) == len(given)
    for row in found:
        ids = packed(given[row.doc_id])
        assert (row.n_tokens, row.ids_sha256) == (len(ids) // 4, hashlib.sha256(ids).hexdigest())
        assert row.decoded_sha256 == hashlib.sha256(given[row.doc_id].encode()).hexdigest()
