"""Finding groups too large for one task, and spreading rows over tasks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lantern.session import durable

# rows of one group that a task may sort and hold on disk without trouble
HOT_GROUP_ROWS = 2_000_000


def with_digest(df: DataFrame, group: Sequence[str]) -> DataFrame:
    """``df`` with ``_k0`` and ``_k1``: 16 bytes that stand for a row's group, however long its keys are.
    Nulls are told apart; of a billion groups two are alike with a chance of one in 10^20."""
    values = [*[F.col(f"`{g}`") for g in group], *[F.col(f"`{g}`").isNull() for g in group]]
    return df.withColumns({f"_k{i}": F.xxhash64(F.lit(i), *values) for i in (0, 1)})


def split_hot(
    df: DataFrame, group: Sequence[str], hot_rows: int = HOT_GROUP_ROWS
) -> tuple[DataFrame, DataFrame | None]:
    """``df`` without its hot groups, and the rows of the hot groups (None if there are none).

    One narrow pass counts rows per group, combined in each task before the shuffle. At most
    rows / hot_rows groups are hot; of each only an 8-byte hash is kept, so that the set can be
    broadcast whatever the keys are. A cold group that shares a hash is treated as hot, which is slower
    and not wrong. ``df`` is read again afterwards: write an expensive one to a table first.
    """
    counts = df.groupBy(*group).agg(F.count(F.lit(1)).alias("_rows"))
    hot = durable(
        counts.where(F.col("_rows") > hot_rows).select(F.xxhash64(*group).alias("_hot")).distinct()
    )
    if hot.isEmpty():
        return df, None
    marked = df.withColumn("_hot", F.xxhash64(*group))
    cold = marked.join(F.broadcast(hot), "_hot", "left_anti")
    rest = marked.join(F.broadcast(hot), "_hot", "left_semi")
    return cold.drop("_hot"), rest.drop("_hot")


def spread(df: DataFrame) -> DataFrame:
    """A table read in fewer pieces than there are cores, dealt out over all of them.

    For row-local work that is heavy on the processor. A table of many files is left as it is, so at
    scale nothing is shuffled. ``df`` must be a plain scan: asking a scan for its pieces costs nothing.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
