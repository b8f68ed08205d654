"""Byte-level BPE against the tiktoken library, and the exact round trip."""

import base64
import hashlib
import random

import public_tokenizers as P
import pytest
import tiktoken

from thermogrid.llm import byte_bpe as B
from thermogrid.llm.common import table

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b)
             for a, b in map(bytes.split, open(P.path("byte_bpe_multi_50k.tiktoken"), "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def vocabulary():
    return B.Vocabulary(open(P.path("byte_bpe_multi_50k.tiktoken"), "rb").read(), P.PATTERN)


def test_random_texts(library, vocabulary):
    rnd = random.Random(3)
    alphabet = [chr(c) for c in range(0, 260)] + list("́٠  　﻿​中\U0001f600\U0001d7ce")
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 80))) for _ in range(2000)]
    texts += ["", "<|endoftext|>", " ", "\n\n  x", "it's we'LL 've"]
    lens, ids = vocabulary.encode_texts(texts)
    at = 0
    for t, n in zip(texts, lens):
        got = ids[at:at + n].tolist()
        at += n
        assert got == library.encode_ordinary(t)
        assert vocabulary.decode_ids(got) == t.encode()


@pytest.mark.parametrize("text", ["a" * 5000, "ab" * 3000, "the" * 900, "!" * 4000, " " * 3000, "é" * 2500])
def test_long_pieces(library, vocabulary, text):
    _, ids = vocabulary.encode_texts([text])
    assert ids.tolist() == library.encode_ordinary(text)


def test_query_matches_library(spark, library):
    docs = table(spark, SF, "documents")
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    rows = B.op10_byte_bpe(docs).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_decode_of_stored_ids(spark):
    docs = table(spark, SF, "documents")
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    assert {r.doc_id: bytes(r.decoded).decode() for r in B.decode(B.encode(docs)).collect()} == texts
    odd = spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")
    assert [bytes(r.decoded) for r in B.decode(odd).collect()] == [b"", b""]


def test_edge_rows(spark):
    rows = [(1, None, "x", 5), (1, "", "y", 6), (None, "a b", None, 7), (1, "a b", "z", 8), (1, "a b", "z", 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string, decoded int")
    got = sorted((r.doc_id or 0, r.n_tokens) for r in B.op10_byte_bpe(docs).collect())
    assert got == [(0, 2), (1, 0), (1, 0), (1, 2), (1, 2)]
    assert B.op10_byte_bpe(docs.limit(0)).count() == 0
