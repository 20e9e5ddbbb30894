"""Byte-level BPE against the library on whole texts, and round trips."""

import random

import public_tokenizers as P
import pytest
from lantern.llm import bpe

PATH = P.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def encodings():
    return bpe.coder(bpe.read_ranks(PATH), P.PATTERN)


@pytest.fixture(scope="module")
def encoding(encodings):
    return encodings[0]


def test_pieces_encode_as_the_whole(encodings, monkeypatch):
    """Small pieces force cuts everywhere that a cut is allowed."""
    draw = random.Random(7)
    signs = ["a", "Zz", "é", "中", "語。", " ", "  ", "\n", "\t", "\x1c", "\x85", " ", "'s", "'", "don't", "12", "٣", "!", "?!", "_", "ab12", "🙂", "-"]
    for size in (1, 2, 3, 8):
        monkeypatch.setattr(bpe, "PIECE", size)
        for _ in range(300):
            text = "".join(draw.choices(signs, k=draw.randrange(40)))
            ids = []
            for piece, single in bpe.pieces(text, size):
                ids += encodings[single].encode_ordinary(piece)
            assert ids == encodings[0].encode_ordinary(text), repr(text)


def test_texts_that_the_pattern_alone_cannot_take(encodings):
    for text in (" " * 3_000_000 + "b", "a" + "\n" * 2_000_000, "x" * 300_000, "word " * 200_000):
        ids = bpe.encode(encodings, text)
        assert encodings[0].decode_bytes(ids) == text.encode()


def test_documents(spark, sf_dir, encoding):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    want = {r.doc_id: encoding.encode_ordinary(r.text) for r in docs.collect()}
    rows = bpe.tokenise(docs, PATH, P.PATTERN).collect()
    assert {r.doc_id: r.ids for r in rows} == want
    assert all(bytes(r.decoded) == encoding.decode_bytes(r.ids) for r in rows)


def test_odd_rows(spark):
    rows = [(1, None), (1, None), (2, ""), (None, "no key"), (3, "é" * 70_000)]
    docs = spark.createDataFrame([(k, t, "x", 1) for k, t in rows], "doc_id long, text string, key string, ids int")
    got = bpe.digests(docs, PATH, P.PATTERN).collect()
    assert sorted(bytes(r.decoded).decode() for r in got) == sorted(t or "" for _, t in rows)
    assert [r.n_tokens for r in got if r.doc_id in (1, 2)] == [0, 0, 0]
    assert bpe.tokenise(docs.limit(0), PATH, P.PATTERN).collect() == []
