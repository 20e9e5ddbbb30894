"""Hard negatives against all pairs, the packed tree against a scan, and odd rows."""

import random

import numpy as np
import pytest
from lantern.llm import negatives, rtree

SCHEMA = "vec_id long, embedding array<double>, label int, id string, score string"


def slow(rows):
    """All anchors against all rows, one by one."""
    valid = []
    for key, vector, label, *_ in rows:
        if key is None or label is None or vector is None or any(x is None or not np.isfinite(x) for x in vector):
            continue
        valid.append((key, (label + 1) % 10 if key % 7 == 0 else label, [int(np.floor(256 * x)) for x in vector]))
    made = []
    for key, label, vector in valid:
        if key % 50:
            continue
        scored = [(-sum(a * b for a, b in zip(vector, v)), k, other) for k, other, v in valid]
        for back, positive, _ in sorted(x for x in scored if x[2] == label and x[1] != key)[:5]:
            inside = sorted((b, k) for b, k, other in scored if other != label and 50 * -back <= 100 * -b <= 95 * -back)
            made += [(key, positive, rank + 1, k, -back, -b) for rank, (b, k) in enumerate(inside[:3])]
    return sorted(made)


def mined(spark, rows, **sizes):
    df = spark.createDataFrame(rows, SCHEMA)
    found = negatives.mine(df, **sizes)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in found.collect())


@pytest.mark.parametrize("sizes", [{}, {"tile_rows": 40, "leaf": 4, "round_bytes": 300, "seed_rows": 100}])
def test_all_pairs(spark, sizes):
    """Random vectors, a third of them copies of one, and every odd row; also with small tiles and many rounds."""
    draw = random.Random(5)
    rows = [(i, [draw.gauss(0, 0.3) for _ in range(6)], draw.randrange(3), "x", "y") for i in range(400)]
    rows = [(k, rows[0][1] if k % 3 == 0 else v, label, a, b) for k, v, label, a, b in rows]
    rows += [(500, [0.0] * 6, 1, None, None), (550, [], 1, None, None), (600, [0.5, -0.25], 0, None, None)]
    rows += [(650, None, 1, None, None), (None, [0.1] * 6, 1, None, None), (700, [0.1] * 6, None, None, None)]
    rows += [(750, [0.1, None], 1, None, None), (800, [float("nan")], 1, None, None), (850, [float("inf")], 2, None, None)]
    rows += rows[100:103] + rows[50:51]
    assert mined(spark, rows, **sizes) == slow(rows)


def test_few_rows(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(50, [1.0], 1, "", "")]) == []
    pair = [(50, [1.0], 1, "", ""), (51, [1.0], 1, "", ""), (52, [0.75], 2, "", "")]
    assert mined(spark, pair) == slow(pair) != []


def test_large_components(spark):
    """Products beyond what doubles hold exactly, and beyond 64 bits."""
    rows = [(k, [2.0**21 + k / 256, -(2.0**20) + (k * k % 97) / 256], k % 2, "", "") for k in range(160)]
    assert mined(spark, rows, tile_rows=40, leaf=4) == slow(rows)
    for size in (2.0**40, 1e30):
        with pytest.raises(Exception, match="64 bits|too large"):
            mined(spark, [(50, [size], 1, "", "")])


def test_tree_against_scan():
    draw = np.random.default_rng(3)
    for case in range(20):
        n, d = int(draw.integers(1, 700)), int(draw.integers(1, 9))
        rows = draw.integers(-20, 20, (n, d)).astype(float)
        if case % 2:
            rows[: n // 2] = rows[0]
        ids = draw.permutation(n)
        leaves = rtree.pack(rows, ids, 8)
        order = np.concatenate(leaves)
        assert sorted(order.tolist()) == list(range(n)) and max(map(len, leaves)) <= 8
        starts = np.cumsum([0, *map(len, leaves[:-1])])
        queries = rows[draw.integers(0, n, 30)]
        low = draw.integers(-200, 100, (30, 3)).astype(float)
        high = low + draw.integers(0, 300, (30, 3))
        found = rtree.Search(queries, np.full(30, -1), low, high, np.full((30, 3), -float(rtree.FAR)), 3)
        found.through(rows[order], ids[order], starts, np.arange(30))
        for q, row in enumerate(queries @ rows.T):
            for w in range(3):
                inside = sorted((-s, i) for s, i in zip(row.tolist(), ids.tolist()) if low[q, w] <= s <= high[q, w])
                assert found.best.get((q, w), []) == inside[:3]


def test_boxes_are_left_out():
    """In a packed tree a search meets a small part of the rows."""
    draw = np.random.default_rng(4)
    rows = draw.normal(0, 100, (20_000, 3)).round()
    ids = np.arange(len(rows))
    leaves = rtree.pack(rows, ids)
    order = np.concatenate(leaves)
    starts = np.cumsum([0, *map(len, leaves[:-1])])
    far = float(rtree.FAR)
    found = rtree.Search(rows[:20], ids[:20], np.full((20, 1), -far), np.full((20, 1), far), np.full((20, 1), -far), 5)
    met = []
    meet, found.meet = found.meet, lambda at, some, those: (met.append(len(at) * len(those)), meet(at, some, those))
    found.through(rows[order], ids[order], starts, np.arange(20))
    assert sum(met) < 0.1 * 20 * len(rows)
