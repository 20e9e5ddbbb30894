"""I-Match against a slow second version."""

import hashlib
import math
import re

import pytest
import xxhash
from lantern.llm import imatch


def signed(text):
    value = xxhash.xxh64(text.encode(), seed=42).intdigest()
    return value - (1 << 64) if value >> 63 else value


def terms(text):
    return {w for w in re.split(r"[\x09-\x0d\x20]+", text.lower()) if w}


def slow(rows, low=imatch.IDF_LOW, high=imatch.IDF_HIGH):
    rows = [(k, t or "") for k, t in rows]
    rows.sort(key=lambda r: (r[0] is None, -(r[0] or 0), signed(r[1])))
    counts = {}
    for _, text in rows:
        for w in terms(text):
            counts[w] = counts.get(w, 0) + 1
    band = {w for w, n in counts.items() if low <= math.log(len(rows) / n) <= high}

    def fingerprint(text):
        own = terms(text)
        own = own & band or own
        parts = [[] for _ in range(128)]
        for w in sorted(own, key=lambda w: w.encode()):
            parts[signed(w) % 128].append(w)
        return [signed(" ".join(p)) % 65535 + 1 if p else 0 for p in parts]

    def near(a, b):
        either = sum(1 for x, y in zip(a, b) if x or y)
        return sum(1 for x, y in zip(a, b) if x and x == y) / either if either else 1.0

    out = []
    for i, (key, text) in enumerate(rows):
        after = rows[(i + 1) % len(rows)][1]
        cut = len(text) // 3
        edited = text[: len(text) - cut] + after[:cut]
        a, b, c = fingerprint(text), fingerprint(edited), fingerprint(after)
        out.append(
            (key, len(text), hashlib.sha256(edited.encode()).hexdigest(), "".join(f"{v:04x}" for v in a),
             "".join(f"{v:04x}" for v in b), near(a, b), near(a, c))
        )
    return sorted(out, key=str)


def got(df):
    return sorted([tuple(r) for r in df.collect()], key=str)


@pytest.mark.parametrize("limit", [50_000, 10])
def test_documents(spark, sf_dir, monkeypatch, limit):
    """Few rows per bucket, so that most successors are in another one; and the joined lexicon."""
    monkeypatch.setattr(imatch, "BUCKET_ROWS", 7)
    monkeypatch.setattr(imatch, "PLAN_TERMS", limit)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    want = slow([tuple(r) for r in docs.collect()])
    assert got(imatch.compare_edits(docs)) == want
    both = dict(imatch.fingerprints(docs).collect())
    assert all(both[r[0]] == r[3] for r in want)


def test_edits_are_nearer_than_neighbours(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = imatch.compare_edits(docs).collect()
    assert sum(r.near_edited > r.near_next for r in rows) > 0.9 * len(rows)


ROWS = [(1, None), (2, ""), (2, ""), (None, "no key é"), (None, "no key"), (-5, "Below zero. Below"), (9, "x"), (9, "y z"), (1 << 62, "far away"), (4, "é " * 30_000)]


@pytest.mark.parametrize("buckets", [1, 3, 2_000])
def test_odd_rows(spark, monkeypatch, buckets):
    monkeypatch.setattr(imatch, "BUCKET_ROWS", buckets)
    docs = spark.createDataFrame([(k, t, "b", 1) for k, t in ROWS], "doc_id long, text string, bucket string, place int")
    assert got(imatch.compare_edits(docs)) == slow(ROWS)


def test_one_and_none(spark):
    docs = spark.createDataFrame([(1, "one two three")], "doc_id long, text string")
    assert got(imatch.compare_edits(docs)) == slow([(1, "one two three")])
    assert got(imatch.compare_edits(docs.limit(0))) == []
