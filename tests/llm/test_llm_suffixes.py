"""Suffix sorting and passage removal against slow second versions."""

import random

import numpy as np
import pyarrow as pa
import pytest
from lantern.llm import induced, suffixes


def slow_order(data, cap):
    ends = [data.index(0, i) for i in range(len(data))]
    order = sorted(range(len(data)), key=lambda i: (data[i : ends[i]], i))

    def common(a, b):
        x, y, k = data[a : ends[a]], data[b : ends[b]], 0
        while k < min(len(x), len(y), cap) and x[k] == y[k]:
            k += 1
        return k

    return order, [common(order[i - 1], order[i]) if i else 0 for i in range(len(order))]


@pytest.mark.parametrize("limit", [1 << 20, 40])
def test_induced_order_and_prefixes(limit):
    """The small limit sends nearly all tuples through the file."""
    draw = random.Random(limit)
    for _ in range(300):
        pieces = [bytes(draw.choices([1, 2, 3, 200][: draw.choice([1, 2, 4])], k=draw.randrange(30))) for _ in range(draw.randrange(6))]
        pieces += [p[draw.randrange(len(p) + 1) :] for p in pieces if draw.random() < 0.5]
        data = b"".join(p + b"\0" for p in pieces)
        order, prefixes = induced.sort_suffixes(np.frombuffer(data, np.uint8), 10, limit)
        assert (order.tolist(), prefixes.tolist()) == slow_order(data, 10)


def slow(rows):
    texts = [(2**63 - 1 if k is None else k, (t or "").encode()) for k, t in rows]
    first = {}
    for key, data in texts:
        for i in range(len(data) - 49):
            s = data[i : i + 50]
            first[s] = min(key, first.get(s, key))
    out = []
    for (key, data), (shown, _) in zip(texts, rows):
        gone = bytearray(len(data))
        for i in range(len(data) - 49):
            if first[data[i : i + 50]] < key:
                gone[i : i + 50] = b"\1" * 50
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out.append((shown, len(data), sum(gone), spans, bytes(b for b, g in zip(data, gone) if not g)))
    return sorted(out, key=str)


def got(df):
    return sorted([(*r[:4], bytes(r[4])) for r in df.collect()], key=str)


def test_documents(spark, sf_dir, monkeypatch):
    """Small blocks and shards, so that passages cross them; short chunks, so that texts are cut."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    want = slow([(r.doc_id, r.text) for r in docs.collect()])
    assert got(suffixes.remove_repeats(docs)) == want and sum(r[2] for r in want) > 0
    monkeypatch.setattr(suffixes, "BLOCK_BYTES", 40_000)
    assert got(suffixes.remove_repeats(docs)) == want


def test_odd_rows(spark):
    passage = "A passage of a good many bytes, é and more, that goes on for long enough to count. "
    rows = [
        (5, passage), (3, f"before {passage}"), (9, passage + passage), (9, passage), (None, passage + "x"), (None, "y" + passage), (7, None), (8, ""),
        (1, "\0" * 60), (2, "\0" * 49 + "a"), (4, "\0" * 51), (6, "ab" * 400), (10, "ba" * 500), (11, "short"), (12, passage[:49]), (13, passage[:50]),
        (-4, passage[20:] + "\0"), (20, "z" * 3000), (21, "z" * 50),
    ]
    docs = spark.createDataFrame([(k, t, 3, "p") for k, t in rows], "doc_id long, text string, block int, piece string")
    assert got(suffixes.remove_repeats(docs)) == slow(rows)
    assert got(suffixes.remove_repeats(docs.limit(0))) == []


def test_chunks_and_shards_change_nothing(monkeypatch):
    draw = random.Random(9)
    base = "".join(draw.choices("abcd ", k=4000)).encode()
    texts = [base[:3000], base[500:], base[::-1], base[100:700] + b"q" + base[100:700]]
    whole = [suffixes.least_documents(texts, np.arange(4))]
    monkeypatch.setattr(suffixes, "CHUNK", 37)
    monkeypatch.setattr(suffixes, "PIECE_WINDOWS", 5)
    for text in texts:
        windows = [w for f, l, _ in suffixes.anchored(np.frombuffer(text, np.uint8)) for a, b in zip(f, l) for w in range(a, b + 1)]
        assert windows == list(range(len(text) - 49))
    for number, text in enumerate(texts):
        for i, least in enumerate(whole[0][number]):
            assert least == min(n for n, t in enumerate(texts) if text[i : i + 50] in t)


def test_copies_of_one_text(spark, monkeypatch):
    """A text with very many copies is dealt out by document; others stay together."""
    passage = "Words that are in very many documents, all of which are the same. "
    rows = [(i, passage) for i in range(40, 0, -1)] + [(100 + i, f"{i} " + passage * 2) for i in range(9)] + [(7, passage), (0, passage[:60]), (50, "b" * 60), (50, "b" * 60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(suffixes, "BLOCK_BYTES", 200)
    for hot in (1_000, 10):
        monkeypatch.setattr(suffixes, "HOT_COPIES", hot)
        assert got(suffixes.remove_repeats(docs)) == slow(rows)


@pytest.mark.parametrize("shard", [2 << 20, 700])
def test_a_shard_names_a_piece_once(monkeypatch, shard):
    """However many blocks have a piece; each anchor has bytes of its own here, as equal windows have one anchor."""
    draw = random.Random(shard)
    rows = []
    for anchor in range(-6, 6):
        some = [bytes(draw.choices([100 + anchor, 120 + anchor], k=140)) for _ in range(2)]
        pieces = [some[0][:60], some[0][5:70], some[0][:60] + some[1], some[1][20:75], some[1][:50]][: draw.randrange(1, 6)]
        for piece in pieces:
            for block in draw.sample(range(9), 4):
                docs = draw.sample(range(50), 2)
                rows.append((anchor, block, piece, min(docs), max(docs)))
    first = {}
    for _, _, piece, least, _ in rows:
        for i in range(len(piece) - 49):
            first[piece[i : i + 50]] = min(least, first.get(piece[i : i + 50], least))
    want = []
    for anchor, block, piece, _, most in rows:
        found = [first[piece[i : i + 50]] for i in range(len(piece) - 49)]
        if min(found) < most:
            want.append((block, anchor, suffixes.digest(piece), np.array(found[:1] if len(set(found)) == 1 else found).tobytes()))
    named, plain = [], suffixes.digest
    monkeypatch.setattr(suffixes, "digest", lambda piece: named.append(bytes(piece)) or plain(piece))
    monkeypatch.setattr(suffixes, "SHARD_BYTES", shard)
    table = pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), suffixes.PIECES)], schema=suffixes.PIECES)
    made = [tuple(r.values()) for b in suffixes.shard_windows(iter(table.to_batches(max_chunksize=7))) for r in b.to_pylist()]
    assert sorted(made) == sorted(want) and len(named) == len(set(named)) < len(want)
