"""Chunking, embedding, index tables, nearest neighbours and prompts."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lantern.functions.neighbours import FOUND, Nearest, few_copies, matrix, numbers
from lantern.functions.text import col
from lantern.functions.vectors import bucket_weights, word_buckets
from lantern.operators.examples import question_prompt
from lantern.operators.inference import predict
from lantern.operators.ranking import first_per_group
from lantern.sources.fixed_values import CHUNK_OVERLAP, CHUNK_SIZE, NEIGHBOURS, NO_INDEX, RETRIEVAL_SYSTEM
from lantern.sources.tables import read_text_documents

# Where a text is split, tried in this order; a separator stays with what follows it.
SEPARATORS = ("\n\n", "\n", " ", "")

Embedder = Callable[[Column], Column]

QUERY_BYTES = 64 << 20  # queries up to this size are sent to every task
QUERY_BLOCK = 32_768  # rows per block beyond it
INDEX_BLOCK = 131_072
BLOCK_NUMBERS = 1 << 24  # and numbers of their vectors
SEARCH_TASKS = 8_192  # each task returns k rows per query, so more tasks mean more rows to merge
ASKED_CELLS = 1 << 22  # distances to cells formed at a time
SENT_ROWS = 16_384  # rows that a task sends on at a time
CELLS_TABLE = 65_536  # upper bound on cells, so that tables of one row per cell can be broadcast


# --- R1 ------------------------------------------------------------------------------------------
def pieces(text: str, separator: str) -> list[str]:
    if not separator:
        return list(text)
    head, *rest = text.split(separator)
    return [p for p in [head, *(separator + r for r in rest)] if p]


def packed(parts: Sequence[str], size: int, overlap: int) -> Iterator[str]:
    """Runs of parts of at most ``size`` characters; a run begins with the tail of the one before."""
    first, total = 0, 0
    for at, part in enumerate(parts):
        if total + len(part) > size:
            if at > first:
                yield "".join(parts[first:at])
            while total > overlap or (total and total + len(part) > size):
                total -= len(parts[first])
                first += 1
        total += len(part)
    yield "".join(parts[first:])


def chunks_of(text: str, size: int, overlap: int, separators: Sequence[str] = SEPARATORS) -> list[str]:
    at = next(i for i, s in enumerate(separators) if s in text)
    out: list[str] = []
    small: list[str] = []

    def flush() -> None:
        out.extend(c.strip() for c in packed(small, size, overlap))
        small.clear()

    for piece in pieces(text, separators[at]):
        if len(piece) < size or not separators[at]:
            small.append(piece)
            continue
        flush()
        rest = separators[at + 1 :]
        out.extend(chunks_of(piece, size, overlap, rest))
    flush()
    return [c for c in out if c]


def chunk_texts(text: Column | str, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP) -> Column:
    """Overlapping chunks of a text as an array (R1): row-local, whole text."""
    if overlap > size:
        raise ValueError("overlap must not be larger than size")

    @F.pandas_udf("array<string>")
    def split(texts: pd.Series) -> pd.Series:
        return pd.Series([[] if t is None else chunks_of(t, size, overlap) for t in texts.tolist()])

    return split(col(text))


def chunk_documents(
    df: DataFrame, key: Sequence[str], text: str = "text", size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP
) -> DataFrame:
    """One row per chunk with its number in the document."""
    return df.select(*key, F.posexplode(chunk_texts(text, size, overlap)).alias("chunk_no", "text"))


# --- R2 ------------------------------------------------------------------------------------------
def fit_word_weights(df: DataFrame, text: str, size: int = 256, portable: bool = False) -> list[float]:
    """Inverse document frequency per hash bucket; ``size`` numbers whatever the size of ``df``."""
    return fit_bucket_weights(df, word_buckets(text, size, portable), size)


def fit_bucket_weights(df: DataFrame, buckets: Column | str, size: int = 256) -> list[float]:
    """The same from a column of ``word_buckets``, so that words which are kept are hashed once."""
    found = F.array_distinct(buckets)
    # one more entry per row counts the rows in the same pass
    marked = df.select(F.explode(F.concat(found, F.array(F.lit(-1)))).alias("bucket"))
    seen = dict(marked.groupBy("bucket").count().collect())
    rows = seen.get(-1, 0)
    return [math.log((rows + 1) / (seen.get(b, 0) + 1)) for b in range(size)]


def hashed_embedder(weights: Sequence[float], portable: bool = False) -> Embedder:
    """The default embedder: TF-IDF over hashed words at unit length (R2)."""
    size = len(weights)
    return lambda text: bucket_weights(word_buckets(text, size, portable), size, weights)


def bucket_embedder(weights: Sequence[float]) -> Embedder:
    """``hashed_embedder`` for a column of ``word_buckets``."""
    return lambda buckets: bucket_weights(buckets, len(weights), weights)


# --- R3, R8 --------------------------------------------------------------------------------------
def write_index(
    chunks: DataFrame, path: str, embed: Embedder, key: Sequence[str], append: bool = False, source: str = "text"
) -> int:
    """Chunks with their vectors as a table; returns how many rows it then holds.

    ``append`` adds only chunks whose key the table does not hold yet. ``source``: the column that is
    embedded; one other than the text is not kept.
    """
    spark = chunks.sparkSession
    rows = chunks.withColumn("embedding", embed(F.col(source)).cast("array<float>"))
    if source != "text":
        rows = rows.drop(source)
    if append:
        rows = rows.join(open_index(spark, path).select(*key), list(key), "left_anti")
    rows.write.mode("append" if append else "overwrite").parquet(path)
    return open_index(spark, path).count()


def ingest(
    spark: SparkSession,
    directory: str,
    path: str,
    embed: Embedder | None = None,
    size: int = CHUNK_SIZE,
    overlap: int = CHUNK_OVERLAP,
    append: bool = False,
) -> tuple[int, Embedder]:
    """The text files of a directory as an index of chunks (S1, R1-R3); returns its number of chunks
    and the embedder to ask questions with. Without one the word weights are fitted on these chunks."""
    chunks = chunk_documents(read_text_documents(spark, directory), ["path"], "text", size, overlap)
    if embed is None:
        embed = hashed_embedder(fit_word_weights(chunks, "text"))
    keyed = chunks.withColumn("id", F.xxhash64("path", "chunk_no"))
    return write_index(keyed, path, embed, ["path", "chunk_no"], append), embed


def open_index(spark: SparkSession, path: str) -> DataFrame:
    """The index table; one that is absent or empty is refused."""
    try:
        index = spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        raise ValueError(NO_INDEX) from e
    if index.isEmpty():
        raise ValueError(NO_INDEX)
    return index


# --- R4, R9 --------------------------------------------------------------------------------------
FOUND_DDL = "query_id bigint, neighbour_id bigint, distance double"


def vectors(df: DataFrame, id_col: str, vector: str) -> DataFrame:
    return df.select(F.col(id_col).cast("bigint").alias("id"), F.col(vector).alias("v"))


@dataclass(frozen=True)
class CellIndex:
    """Vectors (id, v) with the cell they are in, and the centres of the cells."""

    vectors: DataFrame
    centres: np.ndarray


def index_rows(rows: pa.Table | pa.RecordBatch, k: int) -> tuple[np.ndarray, np.ndarray]:
    return few_copies(matrix(rows["v"]), numbers(rows["id"]), k)


def search_with_all_queries(queries: pa.Table, index: DataFrame, k: int, skip_self: bool) -> DataFrame:
    """Every task holds all queries and reads its part of the index once; the index is not shuffled."""
    held = index.sparkSession.sparkContext.broadcast((matrix(queries["v"]), numbers(queries["id"])))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nearest = Nearest(*held.value, k, skip_self)
        for batch in batches:
            if len(batch):
                nearest.meet(*index_rows(batch, k))
        yield nearest.found()

    tasks = max(SEARCH_TASKS, index.sparkSession.sparkContext.defaultParallelism)
    return index.coalesce(tasks).mapInArrow(search, FOUND_DDL)


def dealt_to_blocks(
    df: DataFrame, own: str, n_own: Column, other: str, n_other: Column
) -> DataFrame:
    """Each row in one of its side's blocks by the hash of its id, once for every block it meets."""
    placed = df.withColumn(own, F.pmod(F.xxhash64("id"), n_own).cast("int"))
    return placed.withColumn(other, F.explode(F.sequence(F.lit(0), (n_other - 1).cast("int"))))


def search_pairs(
    queries: DataFrame, index: DataFrame, by: list[str], pairs: int, search: Callable[[pa.Table, pa.Table], Nearest]
) -> DataFrame:
    """Every block of queries meets its block of the index in one call, which returns at most k rows per query."""

    def met(q: pa.Table, x: pa.Table) -> pa.Table:
        return pa.Table.from_batches([search(q, x).found()] if len(q) and len(x) else [], FOUND)

    # more places than pairs of blocks, so that few share one: put together by size they would be few long tasks
    places = min(4 * pairs, SEARCH_TASKS)
    left, right = (side.repartition(places, *by).groupBy(*by) for side in (queries, index))
    return left.cogroup(right).applyInArrow(met, FOUND_DDL)


def block_rows(most: int, width: int) -> int:
    return max(1, min(most, BLOCK_NUMBERS // max(width, 1)))


def search_blocks(queries: DataFrame, index: DataFrame, k: int, skip_self: bool) -> DataFrame:
    """All queries against the whole index, both in blocks of bounded size."""
    rows, width = queries.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("v")), F.lit(1))).first()
    # small tables still have work for every core
    cores = queries.sparkSession.sparkContext.defaultParallelism
    x_blocks = max(1, math.ceil(index.count() / block_rows(INDEX_BLOCK, width)))
    q_blocks = max(1, math.ceil(rows / block_rows(QUERY_BLOCK, width)), math.ceil(2 * cores / x_blocks))
    left = dealt_to_blocks(queries, "_qb", F.lit(q_blocks), "_xb", F.lit(x_blocks))
    right = dealt_to_blocks(index, "_xb", F.lit(x_blocks), "_qb", F.lit(q_blocks))

    def search(q: pa.Table, x: pa.Table) -> Nearest:
        nearest = Nearest(matrix(q["v"]), numbers(q["id"]), k, skip_self)
        nearest.meet(*index_rows(x, k))
        return nearest

    return search_pairs(left, right, ["_qb", "_xb"], q_blocks * x_blocks, search)


def nearest_in_cells(q: pa.Table, x: pa.Table, n_groups: int, k: int, skip_self: bool) -> Nearest:
    """Each query against the rows of those of its ``cells`` that ``x`` has."""
    nearest = Nearest(matrix(q["v"]), numbers(q["id"]), k, skip_self)
    asked = np.frombuffer(b"".join(q["cells"].to_pylist()), "uint8").reshape(len(q), -1)
    of = x["cell"].to_numpy()
    order = np.argsort(of, kind="stable")
    points, ids, cells = matrix(x["v"])[order], numbers(x["id"])[order], of[order]
    starts = np.flatnonzero(np.concatenate([[True], cells[1:] != cells[:-1]]))
    for a, b in zip(starts, [*starts[1:], len(cells)]):
        place = int(cells[a]) // n_groups
        rows = np.flatnonzero(asked[:, place // 8] & (128 >> place % 8))
        nearest.meet(*few_copies(points[a:b], ids[a:b], k), rows)
    return nearest


def to_centres(column: pa.Array, centres: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Slices of the vectors: where each begins, and its squared distances to all centres but for a term of its own."""
    norm, step = (centres * centres).sum(1), max(1, ASKED_CELLS // len(centres))
    for at in range(0, len(column), step):
        yield at, norm[None, :] - 2 * (matrix(column.slice(at, step)) @ centres.T)


def asked_cells(column: pa.Array, centres: np.ndarray, n: int) -> Iterator[tuple[int, np.ndarray]]:
    """Slices of the vectors: where each begins, and marks of the ``n`` nearest cells of each."""
    for at, far in to_centres(column, centres):
        marks = np.full(far.shape, n >= len(centres))
        if n < len(centres):
            np.put_along_axis(marks, np.argpartition(far, n, axis=1)[:, :n], True, axis=1)
        yield at, marks


def in_groups(marks: np.ndarray, n_groups: int) -> np.ndarray:
    """Marks of cells as marks by group (number of the cell modulo ``n_groups``) and place in it."""
    rows, cells = marks.shape
    places = -(-cells // n_groups)
    whole = np.zeros((rows, places * n_groups), bool)
    whole[:, :cells] = marks
    return whole.reshape(rows, places, n_groups).transpose(0, 2, 1)


def search_cells(queries: DataFrame, index: CellIndex, k: int, probes: int | None, skip_self: bool) -> DataFrame:
    """Each query in its nearest cells.

    Cells are searched in groups, somewhat more of them than the index has blocks, with work for every core. A query
    goes to a group once, with a bit for each cell there, and not once to every cell. A group with a
    cell that holds a third of all rows is just more blocks.
    """
    spark, centres = queries.sparkSession, index.centres
    n_cells, width = centres.shape
    probes = min(probes or max(1, math.ceil(n_cells / 8)), n_cells)
    x_rows, q_rows = block_rows(INDEX_BLOCK, width), block_rows(QUERY_BLOCK, width)
    # one row per cell, at most CELLS_TABLE of them; so is what follows
    held = dict(index.vectors.groupBy("cell").count().collect())
    spare = math.ceil(2 * spark.sparkContext.defaultParallelism / max(1, math.ceil(queries.count() / q_rows)))
    n_groups = min(n_cells, max(math.ceil(1.5 * sum(held.values()) / x_rows), spare))

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, groups = np.zeros(n_cells, "int64"), np.zeros(n_groups, "int64")
        for batch in batches:
            for _, marks in asked_cells(batch["v"], centres, probes):
                cells += marks.sum(0)
                groups += in_groups(marks, n_groups).any(2).sum(0)
        for kind, count in (("cell", cells), ("group", groups)):
            some = np.flatnonzero(count)
            columns = [pa.array([kind] * len(some), pa.string()), pa.array(some, pa.int32()), pa.array(count[some])]
            yield pa.RecordBatch.from_arrays(columns, names=["kind", "number", "queries"])

    def sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, marks in asked_cells(batch["v"], centres, probes):
                grouped = in_groups(marks, n_groups)
                row, group = np.nonzero(grouped.any(2))
                bits = np.packbits(grouped, axis=2)
                for a in range(0, len(row), SENT_ROWS):
                    r, g = row[a : a + SENT_ROWS], group[a : a + SENT_ROWS]
                    cells = np.ascontiguousarray(bits[r, g])
                    ends = np.arange(len(r) + 1, dtype="int32") * np.int32(cells.shape[1])
                    packed = pa.Array.from_buffers(pa.binary(), len(r), [None, pa.py_buffer(ends), pa.py_buffer(cells)])
                    taken = [batch[name].take(pa.array(at + r)) for name in ("id", "v")]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(g, pa.int32()), *taken, packed], names=["_group", "id", "v", "cells"]
                    )

    tallied = queries.mapInArrow(tally, "kind string, number int, queries bigint")
    asking = {(r.kind, r.number): r.n for r in tallied.groupBy("kind", "number").agg(F.sum("queries").alias("n")).collect()}
    # the filter on cells prunes directories
    wanted = [cell for cell in held if ("cell", cell) in asking]
    rows = Counter()
    for cell in wanted:
        rows[cell % n_groups] += held[cell]
    blocks = [(g, math.ceil(asking["group", g] / q_rows), math.ceil(n / x_rows)) for g, n in sorted(rows.items())]
    sizes = F.broadcast(spark.createDataFrame(blocks, "_group int, _nq int, _nx int"))
    sent_type = queries.schema["v"].dataType.simpleString()
    q = queries.mapInArrow(sent, f"_group int, id bigint, v {sent_type}, cells binary")
    x = index.vectors.where(F.col("cell").isin(wanted)).withColumn("_group", F.col("cell") % n_groups)
    left = dealt_to_blocks(q.join(sizes, "_group"), "_qb", F.col("_nq"), "_xb", F.col("_nx")).drop("_nq", "_nx")
    right = dealt_to_blocks(x.join(sizes, "_group"), "_xb", F.col("_nx"), "_qb", F.col("_nq")).drop("_nq", "_nx")

    def search(a: pa.Table, b: pa.Table) -> Nearest:
        return nearest_in_cells(a, b, n_groups, k, skip_self)

    return search_pairs(left, right, ["_group", "_qb", "_xb"], max(1, sum(a * b for _, a, b in blocks)), search)


def fit_cells(index: DataFrame, n_cells: int, seed: int, per_cell: int = 128) -> np.ndarray:
    """Cell centres by k-means. Only the centres come from a sample; every row is searched."""
    rows, train_rows = index.count(), n_cells * per_cell
    some = index if rows <= train_rows else index.sample(train_rows / rows, seed)
    points = some.select(array_to_vector(F.col("v").cast("array<double>")).alias("features"))
    model = KMeans(k=n_cells, seed=seed, maxIter=10, initMode="random").fit(points)
    return np.array(model.clusterCenters())


def into_cells(index: DataFrame, n_cells: int | None, seed: int) -> CellIndex:
    if n_cells is None:
        n_cells = min(max(int(math.sqrt(index.count())), 1), 4096)
    if n_cells > CELLS_TABLE:
        raise ValueError(f"at most {CELLS_TABLE} cells")
    centres = fit_cells(index, n_cells, seed)

    @F.arrow_udf("int")
    def cell(v: pa.Array) -> pa.Array:
        found = [far.argmin(axis=1) for _, far in to_centres(v, centres)]
        return pa.array(np.concatenate(found or [np.zeros(0)]), pa.int32())

    return CellIndex(index.withColumn("cell", cell("v")), centres)


def write_cells(
    index: DataFrame,
    path: str,
    index_id: str = "id",
    index_vector: str = "embedding",
    n_cells: int | None = None,
    seed: int = 42,
) -> None:
    """An index split into cells as a table, one directory per cell, so that a search reads only the
    cells it looks into. Rows are range-partitioned, so a large cell is written by many tasks."""
    made = into_cells(vectors(index, index_id, index_vector), n_cells, seed)
    rows = [(i, c.tolist()) for i, c in enumerate(made.centres)]
    centres = index.sparkSession.createDataFrame(rows, "cell int, centre array<double>")
    centres.coalesce(1).write.mode("overwrite").parquet(f"{path}/centres")
    ordered = made.vectors.repartitionByRange("cell", "id")
    ordered.write.mode("overwrite").partitionBy("cell").parquet(f"{path}/vectors")


def open_cells(spark: SparkSession, path: str) -> CellIndex:
    """An index written by :func:`write_cells`; its centres are at most CELLS_TABLE rows."""
    centres = spark.read.parquet(f"{path}/centres").orderBy("cell").collect()
    return CellIndex(spark.read.parquet(f"{path}/vectors"), np.array([r.centre for r in centres]))


def top_k(
    queries: DataFrame,
    index: DataFrame | CellIndex,
    k: int = NEIGHBOURS,
    method: str = "auto",
    query_id: str = "id",
    query_vector: str = "embedding",
    index_id: str = "id",
    index_vector: str = "embedding",
    skip_self: bool = False,
    n_cells: int | None = None,
    probes: int | None = None,
    seed: int = 42,
) -> DataFrame:
    """query_id, rank, neighbour_id, distance: the ``k`` nearest by squared L2, ties by id.

    ``auto`` is exact: queries up to QUERY_BYTES go to every task, more are searched in blocks.
    ``cells`` is approximate (R9): the index is split into cells and a query sees its nearest ones;
    an index from :func:`open_cells` is always searched that way.
    """
    if k < 1:
        raise ValueError("k must be positive")
    if method not in ("auto", "broadcast", "blocks", "cells"):
        raise ValueError(f"Unknown method: {method}. Available: auto, broadcast, blocks, cells")
    q = vectors(queries, query_id, query_vector)
    if isinstance(index, CellIndex):
        return ranked(search_cells(q, index, k, probes, skip_self), k)
    x = vectors(index, index_id, index_vector)
    if method == "cells":
        return ranked(search_cells(q, into_cells(x, n_cells, seed), k, probes, skip_self), k)
    if method in ("auto", "broadcast"):
        width = q.agg(F.max(F.size("v"))).first()[0] or 1
        most = QUERY_BYTES // (8 * max(width, 1))
        if method == "broadcast" or q.limit(most + 1).count() <= most:
            held = q.limit(most + 1).toArrow()
            if len(held) > most:
                raise ValueError(f"more than {most} queries: use blocks")
            if len(held):
                return ranked(search_with_all_queries(held, x, k, skip_self), k)
    return ranked(search_blocks(q, x, k, skip_self), k)


def ranked(found: DataFrame, k: int) -> DataFrame:
    """The best ``k`` of what the tasks found."""
    order = [F.col("distance"), F.col("neighbour_id")]
    return first_per_group(found, ["query_id"], order, k, "rank").select(
        "query_id", "rank", "neighbour_id", "distance"
    )


# --- R5, R6, R7 ----------------------------------------------------------------------------------
def contexts(found: DataFrame, index: DataFrame, index_id: str = "id", text: str = "text") -> DataFrame:
    """Texts of the neighbours joined by newline in rank order (R5). Only ids took part in the search;
    the at most k texts per query are joined here."""
    texts = index.select(F.col(index_id).alias("neighbour_id"), F.col(text).alias("_text"))
    in_order = F.array_sort(F.collect_list(F.struct("rank", "_text")))
    return (
        found.join(texts, "neighbour_id", "left")
        .groupBy("query_id")
        .agg(F.array_join(F.transform(in_order, lambda z: z["_text"]), "\n").alias("context"))
    )


def question_prompts(
    context: DataFrame, questions: DataFrame, question_id: str = "id", question: str = "question"
) -> DataFrame:
    """System message and user message per question (R6); one without any context has an empty one."""
    asked = questions.select(F.col(question_id).alias("query_id"), F.col(question).alias("question"))
    kept = asked.join(context, "query_id", "left").withColumn("context", F.coalesce("context", F.lit("")))
    return kept.select(
        "query_id",
        "question",
        "context",
        F.lit(RETRIEVAL_SYSTEM).alias("system_prompt"),
        question_prompt("context", "question").alias("prompt"),
    )


def answer(
    questions: DataFrame,
    index: DataFrame,
    embed: Embedder,
    load_predictor: Callable,
    k: int = NEIGHBOURS,
    method: str = "auto",
    question_id: str = "id",
    question: str = "question",
    index_id: str = "id",
) -> DataFrame:
    """query_id, question, context, prompt, answer for every question."""
    asked = questions.withColumn("embedding", embed(F.col(question)).cast("array<float>"))
    found = top_k(asked, index, k, method, query_id=question_id, index_id=index_id)
    prompts = question_prompts(contexts(found, index, index_id), questions, question_id, question)
    return predict(prompts, load_predictor, "prompt", system="system_prompt").withColumnRenamed(
        "predicted_answer", "answer"
    )
