"""Connected components of a graph given by its edges, as joins and groupings."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lantern.session import durable


# links that a task holds at most; a round of a graph of more gives each task about half as many
PART_ROWS = 1 << 19


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.hash("a", "b").cast("bigint")), F.bit_xor(F.xxhash64("a", "b"))).first())


def hung(a, b) -> tuple:
    """Of links between ``a`` and ``b`` (arrays) the nodes but the smallest of each connected group, and for each
    of them the smallest."""
    import numpy as np

    names, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    one, two = at[: len(a)], at[len(a) :]
    root = np.arange(len(names))
    while len(one):
        high, low = np.maximum(root[one], root[two]), np.minimum(root[one], root[two])
        np.minimum.at(root, high, low)
        while not np.array_equal(up := root[root], root):
            root = up
        apart = root[one] != root[two]
        one, two = one[apart], two[apart]
    below = np.flatnonzero(root != np.arange(len(names)))
    return names[below], names[root[below]]


def hung_in_tasks(links: DataFrame) -> DataFrame:
    """``links`` (``a``, ``b``) with each ``PART_ROWS`` of a task replaced by what ``hung`` makes of them."""
    limit = PART_ROWS

    def made(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held)
        arrays = [pa.array(x, table.schema.field("a").type) for x in hung(*(table.column(c).to_numpy() for c in ("a", "b")))]
        return pa.RecordBatch.from_arrays(arrays, ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            if held and rows + batch.num_rows > limit:
                yield made(held)
                held, rows = [], 0
            held.append(batch)
            rows += batch.num_rows
        if held:
            yield made(held)

    return links.mapInArrow(run, links.schema)


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the smallest node that it is connected with) of every node of ``edges``
    (columns ``a`` and ``b``, of one type that sorts); an edge may be given in either direction and more
    than once, one from a node to itself gives that node.

    Up to ``PART_ROWS`` links are settled by one task. While there are more, every round hangs each node's larger
    neighbours, then its smaller ones, below the smallest node near it, and each task does the same for what is
    connected within its own links; the number of rounds grows with the logarithm of the longest path. A round's
    minima are formed in each task before the shuffle, no task gets a node's neighbours as one list, and each
    round starts from files in the shared folder. Nothing but a count and two checksums comes to the driver. A
    small graph takes no round: a round is some ten jobs,
    whose plans and threads the driver keeps for a while.
    """
    # written once: what makes the edges may be long, and both links and nodes are read from it
    held = durable(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    links = held.where("a <> b")
    before = _state(links)
    while before[0] > PART_ROWS:
        both = links.union(links.select("b", "a"))
        nearest = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
        large = both.join(nearest, "a").where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
        below = large.groupBy("a").agg(F.min("b").alias("least"))
        small = (
            large.join(below, "a")
            .select(F.explode(F.array("a", "b")).alias("a"), F.col("least").alias("b"))
            .where("a <> b")
            .distinct()
        )
        links = durable(hung_in_tasks(small.coalesce(max(1, 2 * before[0] // PART_ROWS))))
        now = _state(links)
        if now == before:
            break
        before = now
    else:
        links = durable(hung_in_tasks(links.coalesce(1)))
    # by now every node but a root has one link, to its root
    alone = held.select(F.explode(F.array("a", "b")).alias("node"))
    return links.toDF("node", "root").union(alone.select("node", F.col("node").alias("root"))).groupBy("node").agg(F.min("root").alias("root"))
