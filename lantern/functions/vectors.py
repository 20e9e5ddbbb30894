"""Hashed word counts and TF-IDF vectors (R2): row-local, no vocabulary, no shuffle."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from lantern.functions.text import words

# texts whose counts are laid out as one table at a time
SLICE_ROWS = 1024


def word_buckets(text: Column | str, size: int, portable: bool = False) -> Column:
    """Bucket of every word by its hash. ``portable`` uses md5, which is many times slower and which
    other SQL engines reproduce."""

    def bucket(w: Column) -> Column:
        if portable:
            return F.conv(F.substring(F.md5(w), 1, 8), 16, 10).cast("bigint") % size
        return F.pmod(F.xxhash64(w), F.lit(size))

    return F.transform(words(text), lambda w: bucket(w).cast("int"))


def bucket_weights(buckets: Column, size: int, weights: Sequence[float] | None = None) -> Column:
    """Counts per bucket, times ``weights``, at unit length; a text without words is all zero, a null one null."""
    scale = np.ones(size) if weights is None else np.asarray(weights, dtype="float64")

    @F.arrow_udf("array<double>")
    def vector(rows: pa.Array) -> pa.Array:
        made = [np.zeros((0, size))]
        for at in range(0, len(rows), SLICE_ROWS):
            part = rows.slice(at, SLICE_ROWS)
            sizes = pc.list_value_length(part).fill_null(0).to_numpy()
            place = np.repeat(np.arange(len(part)) * size, sizes) + part.flatten().to_numpy()
            v = np.bincount(place, minlength=len(part) * size).reshape(-1, size) * scale
            length = np.sqrt((v * v).sum(1))
            made.append(v / np.where(length > 0, length, 1)[:, None])
        offsets = pa.array(np.arange(len(rows) + 1) * size, pa.int32())
        return pa.ListArray.from_arrays(offsets, np.concatenate(made).ravel(), mask=rows.is_null())

    return vector(buckets)
