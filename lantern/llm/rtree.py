"""A tree of boxes packed by sort-tile-recursive, and a best-first search for the largest inner products.

Rows are sorted by one coordinate and cut into slabs, each slab by the next coordinate, until a leaf's rows are
left. The smallest box around a leaf bounds each coordinate, hence each coordinate's share of an inner product
with a query, hence the product from both sides.
"""

from __future__ import annotations

from bisect import insort
from dataclasses import dataclass, field
from math import ceil

import numpy as np

LEAF = 64
FAN = 16
# queries that meet a tree at a time
QUERIES = 2048
# beyond every product: those are below 2^62, and as a double it is exact
FAR = 1 << 62


def slabs(rows: np.ndarray, ids: np.ndarray, members: np.ndarray, capacity: int, unused: list[int]):
    """The coordinate of the widest spread among those not yet ``unused`` and the members cut along it, ties by
    id; nothing to cut by (equal rows): None and runs in order of id."""
    leaves = ceil(len(members) / capacity)
    spread = rows[members][:, unused].max(0) - rows[members][:, unused].min(0) if unused else np.zeros(1)
    if not spread.any():
        order = members[np.argsort(ids[members], kind="stable")]
        return None, [order[i : i + capacity] for i in range(0, len(order), capacity)]
    axis = unused[int(spread.argmax())]
    count = max(2, ceil(leaves ** (1 / len(unused)) - 1e-9))
    size = capacity * ceil(leaves / count)
    order = members[np.lexsort((ids[members], rows[members, axis]))]
    return axis, [order[i : i + size] for i in range(0, len(order), size)]


def pack(rows: np.ndarray, ids: np.ndarray, capacity: int = LEAF) -> list[np.ndarray]:
    """The rows' places, a list for each leaf; leaves that follow one another lie near one another."""
    leaves: list[np.ndarray] = []
    waiting = [(np.arange(len(rows)), list(range(rows.shape[1])))] if len(rows) else []
    while waiting:
        members, unused = waiting.pop()
        if len(members) <= capacity:
            leaves.append(members[np.argsort(ids[members], kind="stable")])
            continue
        axis, parts = slabs(rows, ids, members, capacity, unused)
        if axis is None:
            leaves += parts
        else:
            left = [u for u in unused if u != axis]
            waiting += [(part, left) for part in reversed(parts)]
    return leaves


@dataclass
class Boxes:
    """One level: the bounds of each box, its smallest id, and where its content starts one level below."""

    low: np.ndarray
    high: np.ndarray
    least: np.ndarray
    starts: np.ndarray

    def above(self, starts: np.ndarray) -> Boxes:
        """Boxes around runs of these that begin at ``starts``."""
        return Boxes(
            np.minimum.reduceat(self.low, starts, axis=0),
            np.maximum.reduceat(self.high, starts, axis=0),
            np.minimum.reduceat(self.least, starts),
            starts,
        )

    def bounds(self, queries: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and largest inner product that a row in each of the ``chosen`` boxes can have with each query."""
        zero = queries.dtype.type(0)
        up, down = np.maximum(queries, zero), np.minimum(queries, zero)
        low, high = self.low[chosen].T, self.high[chosen].T
        return up @ low + down @ high, up @ high + down @ low


def levels(rows: np.ndarray, ids: np.ndarray, starts: np.ndarray) -> list[Boxes]:
    """Boxes from the leaves (runs of rows that begin at ``starts``) up to a level of ``FAN`` at most."""
    made = [Boxes(rows, rows, ids, starts).above(starts)]
    while len(made[-1].starts) > FAN:
        made.append(made[-1].above(np.arange(0, len(made[-1].starts), FAN)))
    return made


@dataclass
class Search:
    """The best rows so far of each query in each of its windows of scores (``low`` to ``high``, both
    included): larger products first, equal ones by smaller id. ``floor``: what the last place has at least."""

    queries: np.ndarray
    own: np.ndarray
    low: np.ndarray
    high: np.ndarray
    floor: np.ndarray
    k: int
    best: dict = field(default_factory=dict)

    def __post_init__(self):
        self.kth = np.maximum(self.low, self.floor)
        self.kth_id = np.full(self.kth.shape, np.iinfo(np.int64).max)

    def wanted(self, at: np.ndarray, low: np.ndarray, high: np.ndarray, least: np.ndarray) -> np.ndarray:
        """Which boxes can still give the query ``at`` something: not outside its windows, not strictly below
        the last place, and where equal to it, not of larger ids only."""
        made = np.zeros(low.shape, bool)
        for window in range(self.low.shape[1]):
            kth, last = self.kth[at, window], self.kth_id[at, window]
            if low.ndim > 1:
                kth, last = kth[:, None], last[:, None]
            top = np.minimum(high, self.high[at, window].reshape(kth.shape))
            made |= (low <= top) & ((top > kth) | ((top == kth) & (least < last)))
        return made

    def meet(self, at: np.ndarray, rows: np.ndarray, ids: np.ndarray) -> None:
        """All ``rows`` of a leaf against the queries ``at``."""
        scores = self.queries[at] @ rows.T
        near, found = np.nonzero(scores >= self.kth[at].min(1)[:, None])
        for query, score, row in zip(at[near].tolist(), scores[near, found].tolist(), ids[found].tolist()):
            if row == self.own[query]:
                continue
            for window in range(self.low.shape[1]):
                if not self.low[query, window] <= score <= self.high[query, window]:
                    continue
                kept = self.best.setdefault((query, window), [])
                if len(kept) < self.k or (-score, row) < kept[-1]:
                    insort(kept, (-score, row))
                    del kept[self.k :]
                    if len(kept) == self.k and -kept[-1][0] >= self.kth[query, window]:
                        self.kth[query, window], self.kth_id[query, window] = -kept[-1][0], kept[-1][1]

    def through(self, rows: np.ndarray, ids: np.ndarray, starts: np.ndarray, chosen: np.ndarray) -> None:
        """The ``chosen`` queries through one tree, whose leaves begin at ``starts``."""
        tree = levels(rows, ids, starts)
        for first in range(0, len(chosen), QUERIES):
            self._through(tree, rows, ids, chosen[first : first + QUERIES])

    def _through(self, tree: list[Boxes], rows: np.ndarray, ids: np.ndarray, chosen: np.ndarray) -> None:
        queries, alive = self.queries[chosen], None
        for below, level in zip([*tree[-2::-1], None], reversed(tree)):
            open_boxes = np.arange(len(level.starts)) if alive is None else np.flatnonzero(alive.any(0))
            low, high = level.bounds(queries, open_boxes)
            keep = self.wanted(chosen, low, high, level.least[open_boxes])
            if alive is not None:
                keep &= alive[:, open_boxes]
            if below is None:
                break
            alive = np.zeros((len(chosen), len(level.starts)), bool)
            alive[:, open_boxes] = keep
            alive = np.repeat(alive, np.diff(np.append(level.starts, len(below.starts))), axis=1)
        # each query's queue: its open leaves, the largest bound first, equal ones by smaller id
        by_id = np.argsort(level.least[open_boxes], kind="stable")
        open_boxes, low, high, keep = open_boxes[by_id], low[:, by_id], high[:, by_id], keep[:, by_id]
        order = np.argsort(np.where(keep, -high, high.dtype.type(FAR)), axis=1, kind="stable")
        ends = np.append(level.starts, len(rows))
        left = keep.sum(1)
        active = np.arange(len(chosen))
        for turn in range(len(open_boxes)):
            active = active[left[active] > turn]
            # strictly below every last place: the rest of the queue is too
            leaf = order[active, turn]
            bound = high[active, leaf]
            active, leaf = (x[bound >= self.kth[chosen[active]].min(1)] for x in (active, leaf))
            if not len(active):
                return
            pick = self.wanted(chosen[active], low[active, leaf], high[active, leaf], level.least[open_boxes[leaf]])
            queue = np.argsort(leaf[pick], kind="stable")
            mine, popped = active[pick][queue], leaf[pick][queue]
            # queries that popped the same box share one product
            for run in np.split(np.arange(len(popped)), np.flatnonzero(np.diff(popped)) + 1):
                if len(run):
                    box = open_boxes[popped[run[0]]]
                    inside = slice(ends[box], ends[box + 1])
                    self.meet(chosen[mine[run]], rows[inside], ids[inside])
