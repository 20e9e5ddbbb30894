"""Chunks, neighbours, index, prompts and batch inference."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lantern.functions import neighbours
from lantern.functions.text import in_slices
from lantern.functions.vectors import bucket_weights, word_buckets
from lantern.operators import inference, retrieval


# --- chunks --------------------------------------------------------------------------------------
def random_text(rng, n):
    seps = [" ", " ", " ", "\n", "\n\n", "\n\n\n", "  "]
    words = ["".join(rng.choices("abcdeé", k=rng.choice([1, 3, 8, 40]))) for _ in range(n)]
    return "".join(w + rng.choice(seps) for w in words)


@pytest.mark.parametrize("size,overlap", [(50, 10), (20, 0), (100, 99), (1000, 200)])
def test_chunk_invariants(size, overlap):
    rng = random.Random(size)
    for _ in range(60):
        text = random_text(rng, rng.randint(0, 120))
        chunks = retrieval.chunks_of(text, size, overlap)
        assert all(0 < len(c) <= size and c == c.strip() for c in chunks)
        at = 0
        for c in chunks:
            # every chunk is a piece of the text and begins no earlier than the one before
            found = text.find(c, at)
            assert found >= 0
            at = found
        # nothing but white space is lost
        if overlap == 0:
            assert "".join("".join(chunks).split()) == "".join(text.split())


def slow_chunks(text, size, overlap, separators):
    """The rule said again, list by list."""
    separator = next(s for s in separators if s == "" or s in text)
    rest = separators[separators.index(separator) + 1 :]
    if separator == "":
        parts = list(text)
    else:
        split = text.split(separator)
        parts = [split[0]] + [separator + s for s in split[1:]]
        parts = [p for p in parts if p != ""]
    result, good = [], []

    def merge(items):
        docs, current = [], []
        for item in items:
            if sum(map(len, current)) + len(item) > size and current:
                docs.append("".join(current).strip())
                while sum(map(len, current)) > overlap or (
                    sum(map(len, current)) + len(item) > size and sum(map(len, current)) > 0
                ):
                    current = current[1:]
            current.append(item)
        docs.append("".join(current).strip())
        return [d for d in docs if d]

    for part in parts:
        if len(part) < size:
            good.append(part)
        else:
            result += merge(good)
            good = []
            result += [part] if not rest else slow_chunks(part, size, overlap, rest)
    return result + merge(good)


def test_chunks_against_the_rule():
    rng = random.Random(3)
    for _ in range(200):
        text = random_text(rng, rng.randint(0, 150))
        size = rng.choice([10, 30, 80, 200])
        overlap = rng.choice([0, 5, size // 4, size - 1])
        want = slow_chunks(text, size, overlap, ["\n\n", "\n", " ", ""])
        assert retrieval.chunks_of(text, size, overlap) == want


def test_chunk_documents(spark):
    df = spark.createDataFrame([(1, "a " * 900), (2, ""), (3, None), (4, "x")], "doc int, text string")
    rows = retrieval.chunk_documents(df, ["doc"]).orderBy("doc", "chunk_no").collect()
    assert [(r.doc, r.chunk_no) for r in rows] == [(1, 0), (1, 1), (1, 2), (4, 0)]
    # consecutive chunks share 200 characters
    assert rows[0].text[-150:] in rows[1].text
    with pytest.raises(ValueError):
        retrieval.chunk_texts("text", 10, 11)


# --- neighbours ----------------------------------------------------------------------------------
def vectors(spark, rows, name="embedding"):
    return spark.createDataFrame(rows, f"id long, {name} array<float>")


def brute(queries, index, k, skip_self=False):
    out = {}
    for qid, q in queries:
        q = np.asarray(q, "float32").astype("float64")
        far = [
            (float(((q - np.asarray(x, "float32").astype("float64")) ** 2).sum()), xid)
            for xid, x in index
            if not (skip_self and xid == qid)
        ]
        out[qid] = [(xid, d) for d, xid in sorted(far)[:k]]
    return out


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.neighbour_id, r.distance))
        assert r["rank"] == len(out[r.query_id])
    return out


def copies_and_points(n=600, width=5):
    """A third of all vectors are one and the same."""
    rng = random.Random(9)
    same = [rng.gauss(0, 1) for _ in range(width)]
    return [(i, same if i % 3 == 0 else [rng.gauss(0, 1) for _ in range(width)]) for i in range(n)]


@pytest.mark.parametrize("method", ["auto", "broadcast", "blocks"])
@pytest.mark.parametrize("skip_self", [False, True])
def test_neighbours_with_many_copies(spark, monkeypatch, method, skip_self):
    monkeypatch.setattr(retrieval, "QUERY_BLOCK", 50)
    monkeypatch.setattr(retrieval, "INDEX_BLOCK", 70)
    rows = copies_and_points()
    df = vectors(spark, rows).repartition(5)
    got = found(retrieval.top_k(df, df, 4, method, skip_self=skip_self))
    want = brute(rows, rows, 4, skip_self)
    assert got.keys() == want.keys()
    for q in want:
        assert [x for x, _ in got[q]] == [x for x, _ in want[q]]
        assert [d for _, d in got[q]] == pytest.approx([d for _, d in want[q]])


def test_more_neighbours_than_rows(spark):
    rows = copies_and_points(4)
    df = vectors(spark, rows)
    assert {len(v) for v in found(retrieval.top_k(df, df, 9, "blocks")).values()} == {4}
    assert {len(v) for v in found(retrieval.top_k(df, df, 9, skip_self=True)).values()} == {3}
    assert retrieval.top_k(df.limit(0), df, 2).count() == 0


def test_many_queries_go_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(retrieval, "QUERY_BYTES", 8 * 5 * 100)
    rows = copies_and_points(300)
    df = vectors(spark, rows)
    assert found(retrieval.top_k(df, df, 2)).keys() == {i for i, _ in rows}
    with pytest.raises(ValueError, match="use blocks"):
        retrieval.top_k(df, df, 2, "broadcast")


def test_cells_find_most_neighbours(spark):
    rng = random.Random(2)
    centres = [[rng.gauss(0, 6) for _ in range(8)] for _ in range(10)]
    rows = [(i, [c + rng.gauss(0, 1) for c in centres[i % 10]]) for i in range(800)]
    df = vectors(spark, rows)
    want = brute(rows, rows, 3, True)
    got = found(retrieval.top_k(df, df, 3, "cells", skip_self=True, n_cells=10, probes=2))
    hits = sum(len({x for x, _ in want[q]} & {x for x, _ in got[q]}) for q in want)
    assert hits / (3 * len(rows)) > 0.9
    every = found(retrieval.top_k(df, df, 3, "cells", skip_self=True, n_cells=10, probes=10))
    assert {q: [x for x, _ in v] for q, v in every.items()} == {q: [x for x, _ in v] for q, v in want.items()}


def test_cells_as_a_table(spark, tmp_path):
    rows = copies_and_points(900)
    df = vectors(spark, rows)
    retrieval.write_cells(df, str(tmp_path), n_cells=6)
    index = retrieval.open_cells(spark, str(tmp_path))
    assert len(index.centres) == 6 and index.vectors.count() == 900
    every = found(retrieval.top_k(df, index, 3, probes=6))
    assert {q: [x for x, _ in v] for q, v in every.items()} == {
        q: [x for x, _ in v] for q, v in brute(rows, rows, 3).items()
    }
    one = retrieval.top_k(df.where("id = 1"), index, 3, probes=1)
    assert one.count() == 3 and one.first().neighbour_id == 1


def test_bad_arguments(spark):
    df = vectors(spark, copies_and_points(4))
    for bad in ({"k": 0}, {"method": "magic"}, {"method": "cells", "n_cells": 10**6}):
        with pytest.raises(ValueError):
            retrieval.top_k(df, df, **bad)


# --- vectors and index ---------------------------------------------------------------------------
def test_hashed_vectors(spark):
    df = spark.createDataFrame([("a b a",), ("",), ("a c",)], "t string")
    out = [r[0] for r in df.select(bucket_weights(word_buckets("t", 16), 16)).collect()]
    assert sum(x * x for x in out[0]) == pytest.approx(1) and set(out[1]) == {0.0}
    weights = retrieval.fit_word_weights(df, "t", 16)
    assert len(weights) == 16 and min(weights) == pytest.approx(np.log(4 / 3)) and max(weights) == pytest.approx(np.log(4))


POLICY = "Returns\n\nProducts can be returned within 30 days.\n\n" + "Warranty lasts twelve months. " * 60


def test_ingest_and_answer(spark, tmp_path):
    texts, index = tmp_path / "texts", str(tmp_path / "index")
    texts.mkdir()
    (texts / "policy.txt").write_text(POLICY)
    (texts / "other.txt").write_text("Support answers within a day.")
    with pytest.raises(ValueError, match="not initialized"):
        retrieval.open_index(spark, index)
    n, embed = retrieval.ingest(spark, str(texts), index)
    assert n == len(retrieval.chunks_of(POLICY, 1000, 200)) + 1
    # the same texts again: nothing new when appended, replaced otherwise
    assert retrieval.ingest(spark, str(texts), index, embed, append=True)[0] == n
    (texts / "third.txt").write_text("A third text.")
    assert retrieval.ingest(spark, str(texts), index, embed, append=True)[0] == n + 1
    assert retrieval.ingest(spark, str(texts), index, embed)[0] == n + 1

    def load():
        return lambda prompts, seeds: [f"  {len(p)} " for p in prompts]

    questions = spark.createDataFrame([(7, "When does support answer?")], "id long, question string")
    r = retrieval.answer(questions, retrieval.open_index(spark, index), embed, load).first()
    assert r.context.split("\n")[0] == "Support answers within a day."
    assert r.prompt == f"Context: {r.context} \n\n Questions: When does support answer?"
    assert r.answer == str(len(r.system_prompt) + 2 + len(r.prompt)) and r.error is None


# --- inference -----------------------------------------------------------------------------------
def test_failures_stay_in_their_row(spark):
    def load():
        def answer(prompts, seeds):
            if "bad" in prompts:
                raise RuntimeError("no")
            return [p.upper() + " " for p in prompts]

        return answer

    df = spark.createDataFrame([("a",), ("bad",), ("c",), (None,)], "prompt string").coalesce(1)
    out = {r.prompt: (r.predicted_answer, r.error) for r in inference.predict(df, load).collect()}
    assert out == {"a": ("A", None), "bad": (None, "no"), "c": ("C", None), None: (None, "no prompt")}


def test_samples_have_their_own_seeds(spark):
    def load():
        return lambda prompts, seeds: [str(s) for s in seeds]

    df = spark.createDataFrame([(1, "a"), (2, "a")], "id int, prompt string")
    first = inference.sample_completions(df, load, 3, "id").collect()
    assert len({r.completion for r in first}) == 6
    again = inference.sample_completions(df, load, 3, "id").collect()
    assert {(r.id, r.sample_no, r.completion) for r in first} == {(r.id, r.sample_no, r.completion) for r in again}
    with pytest.raises(ValueError):
        inference.sample_completions(df, load, 1, "id")


def test_cutting_before_the_model(spark):
    def load_model():
        return lambda prompts, seeds: [str(len(p)) for p in prompts]

    def load_scorer():
        return lambda texts: [len(t) for t in texts]

    def first_letters(text, n):
        return text[:n]

    df = spark.createDataFrame([("x" * 5000, "y")], "prompt string, completion string")
    assert inference.predict(df, load_model, cutter=first_letters).first().predicted_answer == "2048"
    assert inference.predict(df, load_model).first().predicted_answer == "5000"
    assert inference.reward(df, load_scorer, cutter=first_letters).first().reward == 512.0
    assert inference.reward(df, load_scorer).first().reward == 5001.0


def test_contexts_in_rank_order(spark):
    hits = spark.createDataFrame([(1, 2, 10), (1, 1, 11), (2, 1, 10)], "query_id int, rank int, neighbour_id int")
    texts = spark.createDataFrame([(10, "ten"), (11, "eleven")], "id int, text string")
    out = {r.query_id: r.context for r in retrieval.contexts(hits, texts).collect()}
    assert out == {1: "eleven\nten", 2: "ten"}


def test_rewards_that_fail_keep_their_rows(spark):
    def load():
        def score(texts):
            if any("bad" in t for t in texts):
                raise RuntimeError("no score")
            return [len(t) for t in texts]

        return score

    rows = [(i, "p", "bad" if i in (3, 77) else None if i == 5 else "x" * i) for i in range(150)]
    df = spark.createDataFrame(rows, "i long, prompt string, completion string").coalesce(1)
    out = {r.i: (r.reward, r.error) for r in inference.reward(df, load, batch_size=40).collect()}
    assert out[3] == out[77] == (None, "no score") and out[5] == (None, "no prompt")
    assert all(out[i] == (1.0 + i, None) for i in range(150) if i not in (3, 5, 77))


def test_null_texts_have_null_vectors(spark):
    df = spark.createDataFrame([(1, "a b"), (2, None), (3, "")], "i long, text string")
    out = {r.i: r.v for r in df.select("i", bucket_weights(word_buckets("text", 8), 8).alias("v")).collect()}
    assert out[2] is None and sum(out[3]) == 0.0 and len(out[1]) == 8


def test_long_rows_meet_python_a_slice_at_a_time(spark):
    """Batches of long texts become Python objects in parts; every row keeps its place and its value."""
    sizes = [0, 5, None, 900, 10, 10, 2000, 3]
    texts = pa.array([None if n is None else "x" * n for n in sizes])
    words = pa.array([None if n is None else ["w"] * n for n in sizes])
    for column in (texts, words):
        parts = list(in_slices([column, pa.array(range(8))], 1000))
        assert [v for values, _ in parts for v in values] == column.to_pylist()
        assert [i for _, numbers in parts for i in numbers] == list(range(8))
        assert all(len(v) == 1 or sum(len(x or "") for x in v) <= 1000 for v, _ in parts) and len(parts) == 3

    def load():
        return lambda prompts, seeds: [str(len(p)) for p in prompts]

    df = spark.range(60).select("id", F.expr("if(id % 7 = 3, null, repeat('ab ', cast(70000 + id as int)))").alias("prompt")).coalesce(1)
    got = {r.id: r.predicted_answer for r in inference.predict(df, load).collect()}
    assert got == {i: None if i % 7 == 3 else str(3 * (70000 + i)) for i in range(60)}


def test_a_query_goes_once_to_a_group_of_cells(spark, monkeypatch):
    """Searched in many cells, a query is not sent to each: the same neighbours from a few rows per query."""
    draw = np.random.default_rng(4)
    points = [(i, [float(x) for x in draw.normal(size=4)]) for i in range(600)]
    df = spark.createDataFrame(points, "id long, embedding array<float>")
    sent = []
    plain = retrieval.dealt_to_blocks

    def counted(*a):
        sent.append(plain(*a).count())
        return plain(*a)

    monkeypatch.setattr(retrieval, "dealt_to_blocks", counted)
    found = retrieval.top_k(df, df, 3, "cells", skip_self=True, n_cells=100, probes=100).collect()
    assert sorted(found) == sorted(retrieval.top_k(df, df, 3, "broadcast", skip_self=True).collect())
    assert sent[0] <= 600 * 2 * spark.sparkContext.defaultParallelism


def test_chunks_are_cut_and_hashed_once(spark, sf_dir, monkeypatch):
    """The answers' index is made from chunks that were written with their buckets; vectors are as row by row."""
    from lantern.functions import vectors
    from lantern.plans import retrieval as plans

    cut, hashed = [], []
    plain, kept = plans.ingest_chunks, plans.retrieval.write_index
    monkeypatch.setattr(plans, "ingest_chunks", lambda *a: cut.append(1) or plain(*a))

    def written(chunks, *rest, **named):
        plan = chunks._jdf.queryExecution().optimizedPlan().toString()
        hashed.append("md5" in plan or "split" in plan)
        return kept(chunks, *rest, **named)

    monkeypatch.setattr(plans.retrieval, "write_index", written)
    assert plans.rag_answer(spark, sf_dir).count() > 0 and (cut, hashed) == ([1], [False])
    monkeypatch.setattr(vectors, "SLICE_ROWS", 2)
    rows = [([0, 1, 1, 299],), ([],), (None,), (list(range(300)) * 2,), ([7],)]
    scale = np.linspace(0, 3, 300)
    found = spark.createDataFrame(rows, "b array<int>").coalesce(1).select(vectors.bucket_weights(F.col("b"), 300, scale).alias("v"))
    for (row,), (made,) in zip(rows, found.collect()):
        v = np.bincount(np.array(row or [], "int64"), minlength=300) * scale
        length = np.sqrt((v * v).sum())
        assert made == (None if row is None else (v / length if length else v).tolist())


def one_by_one(q, ids, x, x_ids, k, skip_self):
    rows = []
    for a, i in zip(q.astype("float64"), ids):
        far = [float(((a - b) ** 2).sum()) for b in x.astype("float64")]
        near = [(d, int(j)) for d, j in zip(far, x_ids) if np.isfinite(d) and not (skip_self and i == j)]
        rows += [(int(i), j, d) for d, j in sorted(near)[:k]]
    return rows


@pytest.mark.parametrize("kind", ["float32", "float64"])
@pytest.mark.parametrize("away", [0, 1e4, 1e18])
def test_nearest_as_measured_one_by_one(monkeypatch, kind, away):
    """Candidates of single precision lose nothing, also far from the origin, among copies and without numbers."""
    monkeypatch.setattr(neighbours, "TILE", 200)
    monkeypatch.setattr(neighbours, "TILE_COLUMNS", 16)
    draw = np.random.default_rng(6)
    base = draw.normal(size=(40, 5)) + away
    x, q = base[draw.integers(0, 40, 150)].astype(kind), base[:30].astype(kind)
    x += (draw.normal(size=x.shape) * 1e-6).astype(kind) * draw.integers(0, 2, (150, 1))
    x[7, 2], q[3, 1] = np.nan, np.inf
    ids, x_ids = np.arange(30), draw.integers(0, 60, 150)
    for k, skip_self in ((1, True), (4, False)):
        nearest = neighbours.Nearest(q, ids, k, skip_self)
        for at in range(0, 150, 70):
            nearest.meet(*neighbours.few_copies(x[at : at + 70], x_ids[at : at + 70], k))
        got = [tuple(r.values()) for r in nearest.found().to_pylist()]
        with np.errstate(invalid="ignore"):
            assert got == one_by_one(q, ids, x, x_ids, k, skip_self)


def test_few_pairs_are_measured(monkeypatch):
    """Of thousands of copies, and of near copies far from the origin, few are measured term by term."""
    measured = []
    plain = neighbours.Nearest.measure
    monkeypatch.setattr(neighbours.Nearest, "measure", lambda s, rows, x, ids: measured.append(len(rows)) or plain(s, rows, x, ids))
    draw = np.random.default_rng(8)
    copies, near = np.ones((3000, 8), "float32"), (1000 + draw.normal(size=(3000, 8))).astype("float32")
    for x in (copies, near):
        measured.clear()
        nearest = neighbours.Nearest(x[:500], np.arange(500), 3, True)
        nearest.meet(*neighbours.few_copies(x, np.arange(3000), 3))
        assert len(nearest.found()) == 1500 and sum(measured) <= 500 * 3 * 2 * neighbours.CANDIDATES


def test_cells_of_a_query_are_sent_as_bits(spark, monkeypatch):
    """What a query carries to a group of cells is a bit for each cell there."""
    points = [(i, [float(x) for x in np.random.default_rng(i).normal(size=4)]) for i in range(600)]
    df = spark.createDataFrame(points, "id long, embedding array<float>")
    carried = []
    plain = retrieval.dealt_to_blocks

    def seen(rows, *a):
        if "cells" in rows.columns:
            carried.extend(r.n for r in rows.select(F.octet_length("cells").alias("n")).collect())
        return plain(rows, *a)

    monkeypatch.setattr(retrieval, "dealt_to_blocks", seen)
    found = retrieval.top_k(df, df, 3, "cells", skip_self=True, n_cells=100, probes=75)
    assert found.count() == 1800 and max(carried) <= 2
