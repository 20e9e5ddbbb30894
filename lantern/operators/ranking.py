"""Order-based operators that hold when one group has a third of all rows.

A window over a group sorts that group in one task. That is right for groups of bounded size and for
"first few per group" (Spark prunes those before the shuffle), but a full ranking of a huge group needs
its rows spread over many tasks: there, rows are range-partitioned over the whole order, and a row's
place is its place in its partition plus the sizes of the partitions before it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lantern.operators.skew import HOT_GROUP_ROWS, split_hot, with_digest
from lantern.session import durable

# percentile_approx is off by at most 1/ACCURACY of all rows
ACCURACY = 10_000
# up to this many rows per group Spark prunes before the shuffle (windowGroupLimitThreshold)
GROUP_LIMIT = 1000
# beyond this many rows per group they are pruned once more on the way
SALTED_LIMIT, SALTS = 50, 64
# rows that one task may order at the end of a limit
LIMIT_ROWS = 10_000


def positions(df: DataFrame, order: Sequence[Column], name: str = "position") -> DataFrame:
    """Zero-based place of every row in one total order, in no single task.

    The sorted rows are stored first: their partitions, and so the sizes added up below, are the same
    whenever a later stage reads them again.
    """
    placed = durable(df.sort(*order)).withColumn("_at", F.monotonically_increasing_id())
    # the upper bits of the id are the partition, the lower 33 the row in it
    part = F.shiftright("_at", 33).cast("int")
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        "_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start")
    )
    # one row per partition: the number of shuffle partitions bounds it
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(starts), "_part")
        .withColumn(name, F.col("_start") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)))
        .drop("_at", "_part", "_start")
    )


def running_totals(df: DataFrame, order: Sequence[Column], value: str, name: str) -> DataFrame:
    """``df`` with the sum of ``value`` over every row up to its own in one total order, in no single task.

    A scan in two levels: each range partition adds up its own rows, and starts from the sums of the
    partitions before it. Nulls count nothing; rows must differ in ``order``.
    """
    sorted_rows = durable(df.sort(*order)).withColumn("_at", F.monotonically_increasing_id())
    placed = sorted_rows.withColumn("_part", F.shiftright("_at", 33).cast("int"))
    sums = placed.groupBy("_part").agg(F.coalesce(F.sum(value), F.lit(0)).alias("_sum"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # one row per partition: the number of shuffle partitions bounds it
    starts = sums.select(F.col("_part").alias("_of"), F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_start"))
    within = Window.partitionBy("_part").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    own = placed.withColumn("_own", F.coalesce(F.sum(value).over(within), F.lit(0)))
    met = own.join(F.broadcast(starts), F.col("_part") == F.col("_of"))
    return met.withColumn(name, F.col("_start") + F.col("_own")).drop("_at", "_part", "_of", "_start", "_own")


def rank_within(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[Column],
    name: str = "rank",
    hot_rows: int = HOT_GROUP_ROWS,
) -> DataFrame:
    """One-based place of every row in its group; ``order`` must be total within a group.

    Groups of up to ``hot_rows`` rows are ranked by a window, larger ones across tasks.
    """
    cold, hot = split_hot(df, group, hot_rows)
    window = Window.partitionBy(*group).orderBy(*order)
    ranked = cold.withColumn(name, F.row_number().over(window).cast("bigint"))
    if hot is None:
        return ranked
    placed = with_digest(durable(positions(hot, [*[F.col(g) for g in group], *order], "_position")), group)
    # 24 bytes for each hot group, of which there are few
    first = placed.groupBy("_k0", "_k1").agg(F.min("_position").alias("_first"))
    spread_rank = (F.col("_position") - F.col("_first") + 1).alias(name)
    met = placed.join(F.broadcast(first), ["_k0", "_k1"])
    return ranked.unionByName(met.select(*[F.col(f"`{c}`") for c in df.columns], spread_rank))


def first_rows(
    df: DataFrame, n: int | None, key: str, *ties: Column, last: bool = False
) -> DataFrame:
    """The ``n`` rows with the smallest (``last``: largest) numeric ``key``; None or 0 keeps every row.

    A plain ordered limit makes each task send its ``n`` best rows, text and all, to one task. Here two
    narrow passes over ``key`` find a value with at least ``n`` and not many more rows on its side: the
    first guesses values from approximate shares, the second counts what each of them would keep. That
    filter reaches the scan, and only its rows are ordered. Rows without a key come after all others,
    whichever end is wanted.
    """
    if not n:
        return df
    column = F.col(key)
    kind = df.schema[key].dataType
    shares = [2.0**i / ACCURACY for i in range(1, 13)]
    marks = [1 - s if last else s for s in shares]
    seen = df.agg(
        F.count(key).alias("rows"), F.percentile_approx(key, marks, ACCURACY).alias("cuts")
    ).first()
    # shares are approximate and are formed from doubles, so what a cut keeps is counted exactly
    guesses = [F.lit(cut).cast(kind) for cut in sorted(set(seen.cuts or []), reverse=last)]
    sides = [column >= cut if last else column <= cut for cut in guesses]
    if sides and seen.rows >= n:
        kept = df.agg(*[F.count_if(side).alias(f"c{i}") for i, side in enumerate(sides)]).first()
        enough = [side for side, rows in zip(sides, kept) if rows >= n]
        if enough:
            df = df.where(enough[0])
    order = [column.desc_nulls_last() if last else column.asc_nulls_last(), *ties]
    if n <= LIMIT_ROWS:
        return df.orderBy(*order).limit(n)
    return positions(df, order, "_position").where(F.col("_position") < n).drop("_position")


def first_per_group(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], n: int, name: str
) -> DataFrame:
    """The first ``n`` rows of every group with their place.

    Each task sends at most ``n`` rows of a group to the shuffle (WindowGroupLimit), so a hot group does
    no harm for small ``n``. For larger ``n`` the rows of all tasks meet in SALTS places first, so that
    the last task gets n rows from each of those and not from every task. Beyond what Spark prunes, hot
    groups are ranked across tasks.
    """
    if n > GROUP_LIMIT:
        return rank_within(df, group, order, name).where(F.col(name) <= n)
    window = Window.partitionBy(*group).orderBy(*order)
    if n > SALTED_LIMIT:
        # any way of dealing out the rows keeps the first n, so the number of the task will do
        salted = df.withColumn("_salt", F.spark_partition_id() % SALTS)
        inner = Window.partitionBy(*group, "_salt").orderBy(*order)
        df = salted.withColumn(name, F.row_number().over(inner)).where(F.col(name) <= n).drop("_salt", name)
    return df.withColumn(name, F.row_number().over(window)).where(F.col(name) <= n)


def joined_text(
    df: DataFrame,
    group: Sequence[str],
    order: str,
    text: str,
    name: str,
    block: int = 256,
) -> DataFrame:
    """Texts of a group joined in ``order`` without separator.

    Runs of ``block`` consecutive places are joined first, each wherever it lands, so that the task of
    a long group gets a few long texts in place of all its rows.
    """
    run = F.floor(F.col(order) / block)

    def glue(at: str, piece: str) -> Column:
        listed = F.array_sort(F.collect_list(F.struct(F.col(at).alias("at"), F.col(piece).alias("piece"))))
        return F.array_join(F.transform(listed, lambda z: F.coalesce(z.piece, F.lit(""))), "")

    runs = df.groupBy(*group, run.alias("_run")).agg(glue(order, text).alias("_text"))
    return runs.groupBy(*group).agg(glue("_run", "_text").alias(name))
