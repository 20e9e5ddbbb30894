"""Hard negatives by a packed tree of boxes over all vectors (operator 13).

The index is a table: every row with the tile and the leaf that sort-tile-recursive packing gives it. Anchors
go to every task in rounds of bounded size, and each task searches the trees of its own rows best first. No
row of the index moves in a search, and no pair is formed but those that a box cannot rule out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lantern.llm import rtree
from lantern.llm.texts import sampled
from lantern.session import durable, fresh_path

SCALE = 256
ANCHOR_EVERY, SHIFT_EVERY, LABELS = 50, 7, 10
POSITIVES, NEGATIVES = 5, 3
# percent of the positive's score between which a negative's lies
LEAST_SHARE, MOST_SHARE = 50, 95
# rows that one task packs at a time, and rows from which the slabs of larger tables are laid out
TILE_ROWS, SAMPLE_ROWS = 16_384, 20_000
# bytes of vectors in a file of the index
FILE_BYTES = 64 << 20
# bytes of anchors that go to every task in one round
ROUND_BYTES = 16 << 20
# an index of more rows is searched in a hash sample of about so many first: its last place bounds the rest
SEED_ROWS = 4_000_000


def quantised(vector: Column) -> Column:
    """floor(256 * x) of every component, x as double. More than 2^62 after scaling is an error, not a wrap."""
    scaled = lambda x: F.floor(F.lit(float(SCALE)) * x.cast("double"))
    size = F.abs(F.lit(float(SCALE)) * F.array_max(F.transform(vector, lambda x: F.abs(x.cast("double")))))
    return F.when(F.coalesce(size, F.lit(0.0)) > 2.0**62, F.raise_error(F.lit("a component is too large to be scaled"))).otherwise(
        F.transform(vector, scaled)
    )


def prepared(df: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """``id``, ``label`` (as the task shifts it) and ``v`` (whole numbers) of the rows that take part: those
    with a key, a label and a vector whose components are all there and finite."""
    odd = F.exists(F.col("v"), lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    rows = df.select(F.col(f"`{key}`").cast("bigint").alias("id"), F.col(f"`{label}`").cast("bigint").alias("label"), F.col(f"`{vector}`").alias("v"))
    rows = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull()).where(~odd)
    shifted = F.when(F.col("id") % SHIFT_EVERY == 0, (F.col("label") + 1) % LABELS).otherwise(F.col("label"))
    return rows.select("id", shifted.alias("label"), quantised(F.col("v")).alias("v"))


@dataclass
class Form:
    """What all matrices have in common: columns, and whether doubles hold every product exactly."""

    width: int
    exact: bool

    def matrix(self, column: pa.Array):
        """Rows of a list column; shorter vectors are filled up with zeros."""
        import numpy as np

        column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
        sizes = np.asarray(column.value_lengths(), np.int64)
        made = np.zeros((len(sizes), self.width), np.float64 if self.exact else np.int64)
        flat = np.asarray(column.flatten(), np.int64)
        if (sizes == self.width).all():
            return flat.reshape(made.shape).astype(made.dtype)
        row = np.repeat(np.arange(len(sizes)), sizes)
        made[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
        return made


def form_of(rows: DataFrame) -> Form:
    found = rows.agg(F.max(F.size("v")).alias("width"), F.max(F.array_max(F.transform("v", F.abs))).alias("most")).first()
    width, most = found.width or 0, found.most or 0
    if width * most * most >= rtree.FAR:
        raise ValueError("inner products of these vectors do not fit 64 bits")
    # an empty vector is a zero
    return Form(max(1, width), width * most * most < 1 << 52)


def layout(sample, ids, total: int, tile_rows: int) -> tuple:
    """The slabs of one label, laid out from a sample: (axis, cuts, parts within), or in the end how many
    tiles share the place by hash, where the sample cannot tell more or copies leave nothing to cut."""
    import numpy as np

    share = tile_rows * len(ids) / max(total, 1)  # rows of the sample that stand for one tile
    capacity = max(16, ceil(share))

    def cut(members, unused: list[int]):
        # a place of the sample holds its share of the rows, not more than a tile if it can be helped
        if len(members) > capacity:
            axis, parts = rtree.slabs(sample, ids, members, capacity, unused)
            if axis is not None:
                values = [sample[part[0], axis] for part in parts[1:]]
                left = [u for u in unused if u != axis]
                return axis, np.array(values), [cut(part, left) for part in parts]
        return max(1, ceil(len(members) / share)) if share else 1

    return cut(np.arange(len(ids)), list(range(sample.shape[1])))


def place(tree, rows, ids) -> list:
    """For each row its place in a layout and the share of it, by hash, as one number each."""
    import numpy as np

    made, number = np.zeros(len(rows), np.int64), 0
    waiting = [(tree, np.arange(len(rows)))]
    while waiting:
        node, members = waiting.pop()
        if isinstance(node, int):
            mixed = (ids[members].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
            made[members] = number + (mixed % np.uint64(node)).astype(np.int64)
            number += node
        else:
            axis, cuts, parts = node
            slab = np.searchsorted(cuts, rows[members, axis], side="right")
            waiting += [(part, members[slab == i]) for i, part in enumerate(parts)]
    return made


def build(rows: DataFrame, form: Form, tile_rows: int = TILE_ROWS, leaf: int = rtree.LEAF) -> DataFrame:
    """The index of ``rows`` (see :func:`prepared`), written to the shared folder: ``label``, ``tile``,
    ``leaf``, ``id``, ``v``. Every row is in it; the rows of a leaf lie together in a file.

    Slabs down to tiles follow a sample of about ``SAMPLE_ROWS`` rows, tiles are packed whole. A label or a
    vector that holds a large part of the rows is dealt over as many tiles as it needs.
    """
    import numpy as np

    spark = rows.sparkSession
    totals = {r.label: r.n for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    taken = sampled(rows, SAMPLE_ROWS, 13, "id").toArrow()
    labels, ids, matrix = np.asarray(taken["label"], np.int64), np.asarray(taken["id"], np.int64), form.matrix(taken["v"])
    layouts = {}
    for label, total in totals.items():
        some = np.flatnonzero(labels == label)
        layouts[label] = layout(matrix[some], ids[some], total, tile_rows) if total > tile_rows else 1
        if total > tile_rows and not len(some):
            layouts[label] = ceil(total / tile_rows)
    sent = spark.sparkContext.broadcast((form, layouts))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        form, layouts = sent.value
        for batch in batches:
            labels, ids, matrix = np.asarray(batch["label"], np.int64), np.asarray(batch["id"], np.int64), form.matrix(batch["v"])
            tiles = np.zeros(len(ids), np.int64)
            for label in np.unique(labels):
                some = np.flatnonzero(labels == label)
                tiles[some] = place(layouts[int(label)], matrix[some], ids[some])
            yield pa.RecordBatch.from_arrays([batch["label"], pa.array(tiles), batch["id"], batch["v"]], names=["label", "tile", "id", "v"])

    def packed(table: pa.Table) -> pa.Table:
        ids = np.asarray(table["id"], np.int64)
        leaves = rtree.pack(sent.value[0].matrix(table["v"]), ids, leaf)
        order = np.concatenate(leaves)
        number = np.repeat(np.arange(len(leaves)), [len(x) for x in leaves])
        made = table.select(["label", "tile", "id", "v"]).take(pa.array(order))
        return made.append_column("leaf", pa.array(number, pa.int64()))

    schema = "label bigint, tile bigint, id bigint, v array<bigint>"
    path = fresh_path(spark, "vector-index")
    tiled = rows.select("label", "id", "v").mapInArrow(deal, schema)
    files = max(spark.sparkContext.defaultParallelism, ceil(sum(totals.values()) * form.width * 8 / FILE_BYTES))
    tiled = tiled.repartition(files, "label", "tile")
    tiled.groupBy("label", "tile").applyInArrow(packed, schema + ", leaf bigint").write.parquet(path)
    return spark.read.parquet(path)


@dataclass
class Anchors:
    """One round of anchors, as every task gets them: sorted by id; windows and floors for each."""

    form: Form
    ids: object
    labels: object
    matrix: object
    low: object
    high: object


def searched(index: DataFrame, anchors: Anchors, same: bool, k: int, seed_rows: int, round_no: int) -> DataFrame:
    """The ``k`` best rows of each anchor and window over the whole index, among rows of the anchor's label
    (``same``; not its own id) or of other labels: ``round``, ``at``, ``win``, ``id``, ``score``, ``place``.

    A task gives k rows per anchor and window at most, those below the last place of the sample left out.
    """
    import numpy as np

    spark = index.sparkSession
    schema = "at bigint, win int, id bigint, score bigint"
    floor = np.full(anchors.low.shape, -rtree.FAR, anchors.matrix.dtype)

    def over(rows: DataFrame, floor) -> DataFrame:
        sent = spark.sparkContext.broadcast((anchors, floor))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            anchors, floor = sent.value
            if not len(anchors.ids):
                return
            found = rtree.Search(anchors.matrix, anchors.ids, anchors.low, anchors.high, floor, k)
            for batch in batches:
                labels = np.asarray(batch["label"], np.int64)
                tiles, leaves, ids = (np.asarray(batch[n], np.int64) for n in ("tile", "leaf", "id"))
                matrix = anchors.form.matrix(batch["v"])
                # one tree for each run of rows of one label and tile; a leaf cut by a batch's end is two
                turns = np.flatnonzero((np.diff(labels) != 0) | (np.diff(tiles) != 0)) + 1
                for run_of in np.split(np.arange(len(ids)), turns):
                    if not len(run_of):
                        continue
                    inside = slice(run_of[0], run_of[-1] + 1)
                    starts = np.concatenate([[0], np.flatnonzero(np.diff(leaves[inside])) + 1])
                    chosen = np.flatnonzero((anchors.labels == labels[run_of[0]]) == same)
                    if len(chosen):
                        found.through(matrix[inside], ids[inside], starts, chosen)
            flat = [(at, win, row, int(-back)) for (at, win), kept in found.best.items() for back, row in kept]
            if flat:
                arrays = [pa.array(column, pa.int32() if i == 1 else pa.int64()) for i, column in enumerate(zip(*flat))]
                yield pa.RecordBatch.from_arrays(arrays, names=["at", "win", "id", "score"])

        order = Window.partitionBy("at", "win").orderBy(F.desc("score"), "id")
        return rows.mapInArrow(run, schema).withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)

    total = index.count()
    if total > seed_rows:
        some = over(index.where(F.pmod(F.xxhash64("id", F.lit(17)), F.lit(total // seed_rows + 1)) == 0), floor)
        last = some.where(F.col("place") == k).select("at", "win", "score").toArrow()
        floor[np.asarray(last["at"]), np.asarray(last["win"])] = np.asarray(last["score"])
    return over(index, floor).select(F.lit(round_no).alias("round"), "at", "win", "id", "score", "place")


def mine(
    df: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    round_bytes: int = ROUND_BYTES,
    seed_rows: int = SEED_ROWS,
    tile_rows: int = TILE_ROWS,
    leaf: int = rtree.LEAF,
) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``, ``negative_score``: for
    each anchor (key divisible by 50) and each of its first 5 rows of the same label, the first 3 rows of other
    labels whose score lies within 50 and 95 percent of the positive's.

    Rows without a key, a label, a vector or a finite component take no part; an empty vector is a zero, and
    shorter vectors are filled up with zeros. Repeated rows are rows of their own, but no row is a positive of
    an anchor with its key. Fewer rows than asked for: all there are. Extra columns are left out; an empty table
    gives an empty table. Scores are whole numbers, ties go to the smaller key. Vectors whose products do not
    fit 64 bits are an error.
    """
    import numpy as np

    spark = df.sparkSession
    rows = durable(prepared(df, key, vector, label))
    form = form_of(rows)
    index = build(rows, form, tile_rows, leaf)
    chosen = rows.where(F.col("id") % ANCHOR_EVERY == 0)
    rounds = max(1, ceil(chosen.count() * form.width * 8 / round_bytes))
    results = None
    for number in range(rounds):
        part = chosen.where(F.pmod(F.xxhash64("id", F.lit(19)), F.lit(rounds)) == number).toArrow().sort_by([("id", "ascending")])
        ids, labels, matrix = np.asarray(part["id"], np.int64), np.asarray(part["label"], np.int64), form.matrix(part["v"])
        whole = np.full((len(ids), 1), rtree.FAR, matrix.dtype)
        first = durable(searched(index, Anchors(form, ids, labels, matrix, -whole, whole), True, POSITIVES, seed_rows, number))
        positives = first.toArrow()
        at, win = np.asarray(positives["at"], np.int64), np.asarray(positives["place"], np.int64) - 1
        low = np.full((len(ids), POSITIVES), rtree.FAR, matrix.dtype)
        high = -low
        # whole scores s with LEAST * p <= 100 * s <= MOST * p; a p below zero leaves none
        score = positives["score"].to_pylist()
        low[at, win], high[at, win] = [-(-LEAST_SHARE * p // 100) for p in score], [MOST_SHARE * p // 100 for p in score]
        second = searched(index, Anchors(form, ids, labels, matrix, low, high), False, NEGATIVES, seed_rows, number)
        names = spark.createDataFrame(pa.table({"at": pa.array(np.arange(len(ids))), "anchor_id": pa.array(ids)}))
        found = (
            first.select("at", (F.col("place") - 1).alias("win"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
            .join(F.broadcast(names), "at")
            .join(second.select("at", "win", "place", F.col("id").alias("negative_id"), F.col("score").alias("negative_score")), ["at", "win"])
            .select("anchor_id", "positive_id", F.col("place").alias("rank"), "negative_id", "positive_score", "negative_score")
        )
        results = found if results is None else results.union(found)
    return results


def op13_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every anchor of the embeddings."""
    return mine(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


OP13_SQL = """
WITH valid AS (
    SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
    FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), met AS MATERIALIZED (
    SELECT a.id AS anchor_id, r.id, a.label = r.label AS same, list_inner_product(a.v, r.v)::BIGINT AS score
    FROM valid a JOIN valid r ON a.id % 50 = 0 AND a.id <> r.id
), positives AS (
    SELECT anchor_id, id AS positive_id, score AS positive_score FROM met WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM (
    SELECT anchor_id, positive_id, positive_score, id AS negative_id, score AS negative_score,
        row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id)::INTEGER AS rank
    FROM positives JOIN met USING (anchor_id)
    WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
) WHERE rank <= 3
"""
