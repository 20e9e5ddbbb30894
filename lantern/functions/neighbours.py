"""Nearest rows by squared distance (R4, R9): matrix products a tile at a time, results as if measured one by one."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

TILE = 1 << 20  # distances formed at a time
TILE_COLUMNS = 1024  # index rows among them, if there are that many queries
CANDIDATES = 8  # for each neighbour wanted; with more a tile is looked at more closely
MEASURED = 1 << 22  # numbers of the pairs that are measured again at a time
COARSE = 1e30  # squared lengths beyond which single precision is not used
NO_ID = np.iinfo(np.int64).min  # stands for a null id, which comes first as in Spark's order

FOUND = pa.schema([("query_id", pa.int64()), ("neighbour_id", pa.int64()), ("distance", pa.float64())])


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Vectors as the rows of a matrix in their own precision; they must be of one length."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return np.zeros((0, 1))
    sizes = pc.unique(pc.list_value_length(column)).to_pylist()
    if len(sizes) != 1 or sizes[0] is None:
        raise ValueError("vectors must be there and of one length")
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return (flat if flat.dtype.kind == "f" else flat.astype("float64")).reshape(len(column), sizes[0])


def numbers(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Ids, with NO_ID for a null."""
    return pc.fill_null(column, NO_ID).to_numpy()


def squared(x: np.ndarray) -> np.ndarray:
    return np.einsum("ij,ij->i", x, x, dtype="float64")


def few_copies(x: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The rows without those that never are among the ``k`` nearest: of many copies of a vector the first
    ``k`` ids do, one more as a query may skip its own, and ``k`` rows of an id that repeats."""
    bits = np.ascontiguousarray(x).view(f"uint{8 * x.itemsize}")
    draw = np.random.default_rng(7).integers(1, 1 << 63, x.shape[1], dtype="uint64") * np.uint64(2) + np.uint64(1)
    key = np.concatenate([bits[a : a + 8192].astype("uint64") @ draw for a in range(0, len(x), 8192)] or [draw[:0]])
    if len(np.unique(key)) == len(key):
        return x, ids
    order = np.lexsort((ids, key))
    # vectors that merely share a key count as different, and so are kept
    copy = key[order[1:]] == key[order[:-1]]
    at = np.flatnonzero(copy)
    copy[at] = (x[order[at]] == x[order[at + 1]]).all(1)
    new_vector = np.concatenate([[True], ~copy])
    new_id = new_vector | np.concatenate([[True], ids[order[1:]] != ids[order[:-1]]])
    count, place = np.cumsum(new_id), np.arange(len(order))
    before = count - np.maximum.accumulate(np.where(new_vector, count, 0))
    repeats = place - np.maximum.accumulate(np.where(new_id, place, 0))
    kept = np.sort(order[(before <= k) & (repeats < k)])
    return x[kept], ids[kept]


def kth_at_most(far: np.ndarray, k: int) -> np.ndarray:
    """Per row a number that at least ``k`` of its numbers do not exceed: the k-th of the least of each of some
    groups of columns; infinite with fewer than ``k`` columns."""
    rows, columns = far.shape
    if columns < k:
        return np.full(rows, np.inf)
    groups = max(4 * k, 32)
    wide = columns // groups
    if wide > 1:
        far = far[:, : groups * wide].reshape(rows, groups, wide).min(axis=2)
    return np.partition(far, k - 1, axis=1)[:, k - 1].astype("float64")


class Nearest:
    """The ``k`` nearest of the rows met so far for each row of ``q``, by squared distance, ties by id.

    A matrix product in single precision finds candidates: every row that could be nearer than the k-th so
    far, given how far rounding can be off. Only they are measured term by term in double precision, so that
    every way of blocking gives the same result. Numbers that are not finite are near nothing.
    """

    def __init__(self, q: np.ndarray, ids: np.ndarray, k: int, skip_self: bool) -> None:
        self.q, self.ids, self.k, self.skip_self = q, ids, k, skip_self
        with np.errstate(over="ignore", invalid="ignore"):
            self.square = squared(q)
        self.asking = np.isfinite(self.square) & (ids != NO_ID)
        self.longest = self.square[self.asking].max(initial=0.0)
        self.far = np.full((len(q), k), np.inf)
        self.who = np.full((len(q), k), np.iinfo(np.int64).max)

    def meet(self, x: np.ndarray, ids: np.ndarray, rows: np.ndarray | None = None) -> None:
        """Rows ``x`` against the queries at ``rows``, or all."""
        rows = np.flatnonzero(self.asking) if rows is None else rows[self.asking[rows]]
        with np.errstate(over="ignore", invalid="ignore"):
            square = squared(x)
        there = np.isfinite(square)
        if not there.all():
            x, ids, square = x[there], ids[there], square[there]
        if not len(x) or not len(rows):
            return
        if x.shape[1] != self.q.shape[1]:
            raise ValueError(f"queries of {self.q.shape[1]} numbers, index of {x.shape[1]}")
        high = min(len(rows), max(TILE // min(len(x), TILE_COLUMNS), 1))
        wide = max(TILE // high, 1)
        coarse = max(square.max(), self.longest) < COARSE
        right = np.concatenate([x, square[:, None]], axis=1, dtype="float32" if coarse else "float64")
        for at in range(0, len(rows), high):
            part = rows[at : at + high]
            left = self.left(part, right.dtype)
            for a in range(0, len(x), wide):
                b = a + wide
                self.tile(part, left, right[a:b], x[a:b], ids[a:b], square[a:b])

    def left(self, part: np.ndarray, kind: np.dtype) -> np.ndarray:
        made = np.empty((len(part), self.q.shape[1] + 1), kind)
        np.multiply(self.q[part], -2, out=made[:, :-1], casting="same_kind")
        made[:, -1] = 1
        return made

    def tile(
        self, part: np.ndarray, left: np.ndarray, right: np.ndarray, x: np.ndarray, ids: np.ndarray, square: np.ndarray
    ) -> None:
        kind, own = right.dtype, self.square[part]
        # squared distance without the query's own square
        rough = left @ right.T
        # rounding of inputs, of each product and of each sum
        unit = (x.shape[1] + 12) * np.finfo(kind).eps / 2
        off = unit * (np.sqrt(own) + np.sqrt(square.max())) ** 2 + 1e-36
        edge = np.nextafter((self.far[part, -1] - own + off).astype(kind), kind.type(np.inf))
        near = np.flatnonzero(rough.min(axis=1) <= edge)
        part, rough, edge = part[near], rough[near], edge[near]
        hit, many = rough <= edge[:, None], CANDIDATES * self.k * len(part)
        if np.count_nonzero(hit) > many:
            if self.skip_self:
                rough[self.ids[part][:, None] == ids[None, :]] = np.inf
            least = kth_at_most(rough, self.k) + 2 * off[near]
            edge = np.minimum(edge, np.nextafter(least.astype(kind), kind.type(np.inf)))
            hit = rough <= edge[:, None]
            if kind == np.float32 and np.count_nonzero(hit) > many:
                again = np.concatenate([x, square[:, None]], axis=1, dtype="float64")
                return self.tile(part, self.left(part, again.dtype), again, x, ids, square)
        spots, step = np.flatnonzero(hit), max(MEASURED // max(x.shape[1], 1), 1)
        for at in range(0, len(spots), step):
            i, j = np.divmod(spots[at : at + step], len(x))
            self.measure(part[i], x[j], ids[j])

    def measure(self, rows: np.ndarray, x: np.ndarray, ids: np.ndarray) -> None:
        """Pairs of a query's row and an index row; ``rows`` ascend."""
        far = ((self.q[rows].astype("float64") - x.astype("float64")) ** 2).sum(1)
        last = self.far[rows, -1]
        better = (far < last) | ((far == last) & np.isfinite(far) & (ids < self.who[rows, -1]))
        if self.skip_self:
            better &= ids != self.ids[rows]
        rows, far, ids = rows[better], far[better], ids[better]
        if not len(rows):
            return
        some = rows[np.concatenate([[True], rows[1:] != rows[:-1]])]
        rows = np.concatenate([np.repeat(some, self.k), rows])
        far = np.concatenate([self.far[some].ravel(), far])
        ids = np.concatenate([self.who[some].ravel(), ids])
        order = np.lexsort((ids, far, rows))
        first = np.searchsorted(rows[order], some)
        kept = order[first[:, None] + np.arange(self.k)]
        self.far[some], self.who[some] = far[kept], ids[kept]

    def found(self) -> pa.RecordBatch:
        """A row for each query and neighbour, at most ``k`` of each query."""
        there = np.isfinite(self.far)
        who = self.who[there]
        columns = [np.repeat(self.ids, there.sum(1)), pa.array(who, mask=who == NO_ID), self.far[there]]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=FOUND)
