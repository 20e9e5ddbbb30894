"""Walking over a table's texts in Arrow batches of bounded size."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# bytes of text that a task holds in Python at a time (one longer text is held alone)
SLICE_BYTES = 4 << 20

Rows = Callable[[list, list], Iterable[dict]]


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows whose ``column`` has about ``limit`` bytes at most."""
    start, held = 0, 0
    lengths = pc.binary_length(batch.column(column)).fill_null(0).to_pylist()
    for row, length in enumerate(lengths):
        if held and held + length > limit:
            yield batch.slice(start, row - start)
            start, held = row, 0
        held += length
    if start < batch.num_rows:
        yield batch.slice(start)


def keyed(df: DataFrame, key: str, text: str) -> DataFrame:
    """Two columns of the table under fixed names, so that other columns cannot clash; null is empty."""
    return df.select(F.col(f"`{key}`").alias("key"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))


def sampled(df: DataFrame, rows: int, salt: int, *columns: str) -> DataFrame:
    """About ``rows`` rows, or all if there are no more: those whose hash of ``columns`` is below a bound
    that follows from the number of rows. No task sends more than its share, whatever the table's size;
    twice as many rows are the most that come."""
    total = df.count()
    if total <= rows:
        return df
    space = 1 << 40
    bound = max(1, rows * space // total)
    return df.where(F.pmod(F.xxhash64(*columns, F.lit(salt)), F.lit(space)) < bound).limit(2 * rows)


def map_texts(df: DataFrame, rows: Callable[[], Callable], schema: str, arrow: pa.Schema) -> DataFrame:
    """``rows()`` is called once per task and gives a function from a text to a tuple of values, which
    follow the key in ``schema``. No row moves to another task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = rows()
        for batch in batches:
            for part in slices(batch, "text"):
                made = [work(text) for text in part.column("text").to_pylist()]
                columns = list(zip(*made)) if made else [[] for _ in arrow]
                arrays = [pa.array(values, field.type) for values, field in zip(columns, list(arrow)[1:])]
                yield pa.RecordBatch.from_arrays([part.column("key"), *arrays], schema=arrow)

    return df.mapInArrow(run, schema)
