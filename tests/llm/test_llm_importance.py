"""Checksums of runs against zlib, and the drawn documents against a slow version."""

import hashlib
import math
import random
import re
import zlib

import pytest
from lantern.llm import importance, prefixcrc

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
SCHEMA = "doc_id long, text string, rank string, bucket int"


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def runs(text, width=2):
    w = words(text)
    return [" ".join(w[i : i + n]).encode() for n in range(1, width + 1) for i in range(len(w) - n + 1)]


@pytest.mark.parametrize("size", [1, 7, 40, 1 << 20])
def test_checksums(size):
    draw = random.Random(size)
    for _ in range(200):
        text = "".join(draw.choice("abXY09 .,éß\n\0世") for _ in range(draw.randrange(120)))
        for width in (1, 2, 4):
            found = list(prefixcrc.checksums(text.encode(), width, size))
            assert sum(n for n, _ in found) == len(words(text))
            assert sorted(x for _, part in found for x in part.tolist()) == sorted(map(zlib.crc32, runs(text, width)))


def slow(docs, target):
    s, t = [0] * 10_000, [0] * 10_000
    for counts, rows in ((s, docs), (t, target)):
        for _, text in rows:
            for run in runs(text):
                counts[zlib.crc32(run) % 10_000] += 1
    all_s, all_t = sum(s), sum(t)
    gain = [math.floor(1000 * math.log(((t[b] + 1) * (all_s + 10_000)) / ((s[b] + 1) * (all_t + 10_000)))) for b in range(10_000)]
    made = []
    for key, text in docs:
        found = [gain[zlib.crc32(run) % 10_000] for run in runs(text)]
        weight = sum(found) // len(found) if found else 0
        h = None if key is None else int(hashlib.sha256(f"7:{key}".encode()).hexdigest()[:8], 16)
        score = None if key is None else weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        made.append([key, len(found), weight, score, None, len(words(text))])
    able = sorted((r for r in made if r[3] is not None and r[5] >= 20), key=lambda r: (-r[3], r[0], r[1], r[2]))
    for rank, row in enumerate(able[: 25 * len(able) // 100]):
        row[4] = rank + 1
    return sorted((tuple(r[:5]) for r in made), key=str)


def drawn(spark, docs, target):
    df = spark.createDataFrame([(k, t, "x", 1) for k, t in docs], SCHEMA)
    made = importance.resample(df, spark.createDataFrame(target, "item long, text string"))
    return sorted((tuple(r) for r in made.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=str)


def test_odd_documents(spark):
    """Nulls, empty and long texts, repeated rows, rows without a key, and nothing at all."""
    draw = random.Random(2)
    lexicon = [draw.choice(["ab", "Cd", "é", "7"]) + str(draw.randrange(40)) for _ in range(200)]
    docs = [(i, " ".join(draw.choices(lexicon, k=draw.randrange(60)))) for i in range(200)]
    docs += [(300, None), (301, ""), (302, "!!! ..."), (None, "a " * 40), (None, None), docs[3], docs[3], (5, "b " * 30)]
    docs += [(303, "x" * 2_500_000 + " y"), (304, "word " * 600_000)]
    target = [(1, " ".join(lexicon[:50])), (2, None), (None, "ab1 Cd2")]
    assert drawn(spark, docs, target) == slow(docs, target)
    assert drawn(spark, docs[:9], []) == slow(docs[:9], [])
    assert drawn(spark, [], target) == []


def test_equal_texts(spark):
    """A third of all rows are one text: ranks stay 1, 2, 3... and no score is shared by many."""
    docs = [(i, "one two three " * 8 if i % 3 else f"w{i} " * 25) for i in range(3000)]
    made = drawn(spark, docs, [(1, "one two")])
    assert made == slow(docs, [(1, "one two")])
    assert sorted(r[4] for r in made if r[4]) == list(range(1, 751))
