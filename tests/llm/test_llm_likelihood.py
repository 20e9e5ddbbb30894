"""Plain counts and the verdict against slow versions, the share of clean and bad documents, odd rows."""

import math
import random
import re
import zlib
from collections import Counter

import pytest
from lantern.llm import likelihood
from pyspark.sql import functions as F

WORDS = re.compile("[^\x20\x09-\x0d]+")
SCHEMA = "doc_id long, text string, kept string, trusted int"
LABELS = "doc_id long, quality int, toxic int, text string"


def slow_counts(text):
    w = WORDS.findall(text)
    windows = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
    often = {x for x, n in Counter(windows).items() if n > 1}
    covered = {i + j for i, x in enumerate(windows) if x in often for j in range(8)}
    lines = [x for x in text.split("\n") if WORDS.search(x)]
    return len(w), sum(map(len, w)), len(re.findall("[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def test_counts():
    draw = random.Random(1)
    for _ in range(400):
        text = "".join(draw.choice(["a", "b", " ", " ", "\n", "é", " ", "\x85", "#", "|", "\x0b", "世"]) for _ in range(draw.randrange(150)))
        assert likelihood.counts(text, text.encode()) == slow_counts(text)
    assert likelihood.counts("", b"") == (0, 0, 0, 0, 0)
    assert likelihood.counts("a " * 9, b"a " * 9) == (9, 9, 0, 0, 9)


@pytest.mark.parametrize("size", [1, 9, 1 << 20])
def test_features(size):
    """The same runs whatever the size of the blocks."""
    text = "The Énd... of *** it,and  that\n" * 9
    tokens = re.findall("[0-9a-z\x80-\U0010ffff]+|[^0-9a-z\x80-\U0010ffff\x09-\x0d ]+", "".join(c.lower() if c < "\x80" else c for c in text))
    pairs = [f"{a} {b}" for a, b in zip(tokens, tokens[1:])]
    want = [zlib.crc32(x.encode()) % 64 for x in tokens] + [64 + zlib.crc32(x.encode()) % 64 for x in pairs]
    found = list(likelihood.features(text.encode(), 64, size))
    assert sorted(x for _, part in found for x in part) == sorted(want) and sum(n for n, _ in found) == len(tokens)


def test_clean_documents_stay(spark):
    """Labelled documents that fitting does not see: the clean stay, the others mostly go."""
    sf_dir = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in ("documents", "labels"))
    seen = labels.where("doc_id % 2 = 0")
    found = {r.doc_id: r for r in likelihood.judge(docs, seen, stratum="lang").collect()}
    groups = {"clean": [], "junk": [], "toxic": []}
    for row in labels.where("doc_id % 2 = 1").collect():
        if not found[row.doc_id].base_failed:
            name = "junk" if row.quality == 0 else "toxic" if row.toxic else "clean"
            groups[name].append(found[row.doc_id].kept)
    share = {name: sum(kept) / len(kept) for name, kept in groups.items()}
    assert share["clean"] > 0.97 and share["junk"] < 0.05 and share["toxic"] < 0.7, share


def test_odd_documents(spark):
    """Nulls, empty and long texts, repeats, rows without a key, no labels, and nothing at all."""
    draw = random.Random(2)
    rows = [(i, " ".join(draw.choices(["one", "two", "three", f"w{i}"], k=40)), "x", 1) for i in range(60)]
    rows += [(70, None, "", 0), (71, "", "", 0), (72, " \n ", "", 0), (None, "a b " * 30, "", 0), rows[3], rows[3]]
    rows += [(73, "y" * 2_500_000, "", 0), (74, " ".join(f"v{i}" for i in range(200_000)), "", 0)]
    labels = [(i, i % 2, 0, "t") for i in range(60)] + [(None, 1, 0, "t"), (3, 0, 0, "t"), (5, None, 0, "t"), (7, 1, None, "t"), (9, 1, 0, "t"), (9, 1, 0, "t")]
    docs, some = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, LABELS)
    assert {r.trusted for r in likelihood.trusted_keys(some).collect()} == {i for i in range(1, 60, 2)} - {3, 5, 7}
    made = likelihood.judge(docs, some).collect()
    assert len(made) == len(rows)
    by_key = {r.doc_id: r for r in made}
    for key, text, *_ in rows:
        r = by_key[key]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == slow_counts(text or "")
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words) and not (r.base_failed and r.kept)
    assert len({tuple(r) for r in made if r.doc_id == 3}) == 1
    # a stratum of its own for few rows changes nothing
    assert sorted(map(str, likelihood.judge(docs, some, stratum="kept").drop("stratum").collect())) == sorted(str(r) for r in likelihood.judge(docs, some).drop("stratum").collect())
    # without labels nothing is known against a text
    for r in likelihood.judge(docs, some.limit(0)).collect():
        assert r.score == 0 and r.kept == (not r.base_failed)
    assert likelihood.judge(docs.limit(0), some).collect() == []


def test_join_beyond_the_broadcast(spark, monkeypatch):
    """More trusted keys than are broadcast are joined, with the same weights."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    trusted = likelihood.trusted_keys(spark.read.parquet("/root/testdata/sf0.001/labels.parquet"))
    few = likelihood.fit(docs, trusted)
    monkeypatch.setattr(likelihood, "BROADCAST_KEYS", 3)
    many = likelihood.fit(docs, trusted)
    assert (few.weights == many.weights).all() and few.weights.any()
    totals = {False: [0, 0], True: [0, 0]}
    tokens = Counter()
    good = Counter()
    keys = {r.trusted for r in trusted.where(likelihood.counted(F.col("trusted"))).collect()}
    for row in docs.collect():
        for _, found in likelihood.features((row.text or "").encode()):
            tokens.update(found)
            if row.doc_id in keys:
                good.update(found)
    for b, n in tokens.items():
        totals[b >= likelihood.BUCKETS][0] += n
        totals[b >= likelihood.BUCKETS][1] += good[b]
    for b, n in tokens.items():
        s, t = totals[b >= likelihood.BUCKETS]
        k = likelihood.SMOOTH[b >= likelihood.BUCKETS]
        assert few.weights[b] == math.floor(1000.0 * math.log((good[b] + k) / (float(n) * t / s + k)))
