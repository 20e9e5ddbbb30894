"""The weak-label classifier: held-out accuracy, the estimator on votes with known accuracies, odd rows."""

import random

import numpy as np
import pytest
from lantern.llm import quality

DATA = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def fitted(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    halves = labels.randomSplit([0.5, 0.5], 3)
    return quality.fit(spark, docs, halves[0]), docs, halves[1]


def test_held_out_accuracy(fitted):
    model, docs, held = fitted
    rows = quality.score(docs, model).join(held.withColumnRenamed("toxic", "is_toxic"), "doc_id").collect()
    junk = [r.junk >= 0.5 for r in rows if r.quality == 0]
    clean = [r.accepted for r in rows if r.quality == 1 and r.is_toxic == 0]
    toxic = [not r.accepted for r in rows if r.is_toxic == 1]
    assert np.mean(junk) > 0.95 and np.mean(clean) > 0.97 and np.mean(toxic) > 0.8


def test_accepted_is_score(spark, fitted):
    model, docs, _ = fitted
    some = docs.where("doc_id < 300")
    want = {r.doc_id for r in quality.score(some, model).where("accepted").collect()}
    kept = quality.accepted(some, model)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == want


def test_odd_rows(spark, fitted):
    model = fitted[0]
    rows = [(1, None), (2, ""), (3, " \n"), (None, "plain words here"), (4, "x"), (4, "x"), (5, "word " * 400_000), (6, "!!!")]
    docs = spark.createDataFrame([(k, t, "a", 1.0) for k, t in rows], "doc_id long, text string, votes string, junk double")
    got = quality.score(docs, model).collect()
    assert len(got) == len(rows)
    assert {r.votes for r in got if r.doc_id in (1, 2, 3, 6)} == {"-" * 10}
    assert not any(r.accepted for r in got if r.doc_id in (1, 2, 3, 5, 6))
    assert quality.score(docs.limit(0), model).collect() == [] and quality.accepted(docs, model).count() == 3


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = quality.fit(spark, docs, labels)
    assert quality.score(docs, model).collect() == [] and not model.lexicon.words


def test_estimator_finds_accuracies():
    draw = random.Random(4)
    right = [0.95, 0.85, 0.75, 0.9]
    counts, truth = {}, {}
    for _ in range(20_000):
        bad = draw.random() < 0.2
        votes = "".join(
            "-" if draw.random() < 0.1 else str(int(bad if draw.random() < (p if bad else 0.98) else not bad)) for p in right
        )
        counts[votes] = counts.get(votes, 0) + 1
        truth.setdefault(votes, []).append(bad)
    posterior = quality.estimate(counts)
    wrong = sum(abs(posterior[v] - np.mean(t)) * len(t) for v, t in truth.items()) / 20_000
    assert wrong < 0.02


def test_profile_is_the_same_in_blocks(monkeypatch):
    lexicon = quality.Lexicon(frozenset(), frozenset())
    text = "Some words, THEN others... and more!! | again again and again " * 40
    whole = quality.profile(text, lexicon)
    cut = quality.blocks
    monkeypatch.setattr(quality, "blocks", lambda t: cut(t, 40))
    parts = quality.profile(text, lexicon)
    assert parts.votes == whole.votes and (parts.features == whole.features).all()


def test_the_fit_holds_few_features_at_a_time(monkeypatch):
    """Training rows are laid out in parts on the driver: the same weights, a fraction of the memory."""
    import tracemalloc

    import numpy as np

    draw = np.random.default_rng(5)
    rows = [np.unique(draw.zipf(1.3, 900) % quality.FEATURES).astype("<i4") for _ in range(2000)]
    targets = draw.random(len(rows))
    whole = quality.fit_linear(rows, targets, rounds=5)
    monkeypatch.setattr(quality, "FIT_CHUNK", 1 << 14)
    tracemalloc.start()
    parts = quality.fit_linear(rows, targets, rounds=5)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert np.allclose(whole[0], parts[0], atol=1e-12) and abs(whole[1] - parts[1]) < 1e-12
    assert peak < 20e6 + 8 * sum(map(len, rows))
