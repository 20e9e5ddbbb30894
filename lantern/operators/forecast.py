"""Forecasts from price histories (T1-T4, P12): every symbol in one job."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lantern.functions.numbers import exact_round
from lantern.functions.text import col
from lantern.operators.ranking import first_per_group, positions
from lantern.operators.skew import HOT_GROUP_ROWS, split_hot

LAST = 5
# rows of a long history that one task averages at a time
BLOCK_ROWS = 1_000_000


def last_rows_per_symbol(df: DataFrame, symbol: str, order: Sequence[str], n: int = LAST) -> DataFrame:
    """The newest ``n`` rows of every symbol."""
    return first_per_group(df, [symbol], [F.col(c).desc() for c in order], n, "_place").drop("_place")


def summary_text(symbol: Column | str, prediction: Column | str) -> Column:
    """The sentence that goes with a forecast."""
    price = col(prediction)
    # from ten million on a double would print with an exponent
    plain = F.regexp_replace(F.format_string("%.2f", price), "0$", "")
    shown = F.when(F.abs(price) < 1e7, price.cast("string")).otherwise(plain)
    return F.concat(F.lit("Predicted price for "), col(symbol).cast("string"), F.lit(" is $"), shown)


def forecast(
    df: DataFrame, symbol: str = "symbol", order: Sequence[str] = ("ts",), close: str = "close", n: int = LAST
) -> DataFrame:
    """Mean of the last ``n`` closes to two decimals, its summary and the rows used."""
    used = F.array_sort(F.collect_list(F.struct(*order, close)))
    return (
        last_rows_per_symbol(df, symbol, order, n)
        .groupBy(symbol)
        .agg(exact_round(F.avg(close), 2).alias("prediction"), used.alias("details"))
        .withColumn("summary", summary_text(symbol, "prediction"))
    )


def rolling_forecast(
    df: DataFrame,
    symbol: str = "symbol",
    order: Sequence[str] = ("ts",),
    close: str = "close",
    n: int = LAST,
    hot_rows: int = HOT_GROUP_ROWS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``df`` plus the forecast as of every row: mean of it and the ``n - 1`` rows before (T4).

    Symbols of up to ``hot_rows`` rows are done by a window; longer ones are cut into blocks of ``block_rows``
    rows of one order over all of them, wherever in time their rows lie.
    """
    cold, hot = split_hot(df, [symbol], hot_rows)
    rows = Window.partitionBy(symbol).orderBy(*[F.col(c) for c in order]).rowsBetween(1 - n, 0)
    done = cold.withColumn("forecast", F.avg(close).over(rows))
    if hot is None:
        return done
    return done.unionByName(rolling_by_block(hot, symbol, order, close, n, block_rows))


def rolling_by_block(
    df: DataFrame, symbol: str, order: Sequence[str], close: str, n: int, block_rows: int
) -> DataFrame:
    """The rolling mean with rows dealt out by their place in one order over (symbol, order).

    Places have no gaps, so the last n - 1 rows before a block are the last ones of the block before it: those
    go to both, and no block is longer than ``block_rows`` + n - 1 rows, be it one symbol in one instant.
    """
    size = max(block_rows, n)
    placed = positions(df, [F.col(symbol), *[F.col(c) for c in order]], "_place")
    own = F.floor(F.col("_place") / size)
    ahead = (F.col("_place") % size) >= size - (n - 1)
    blocks = F.when(ahead, F.array(own, own + 1)).otherwise(F.array(own))
    met = placed.withColumns({"_own": own, "_block": F.explode(blocks)})
    rows = Window.partitionBy("_block", symbol).orderBy("_place").rowsBetween(1 - n, 0)
    made = met.withColumn("forecast", F.avg(close).over(rows))
    return made.where(F.col("_own") == F.col("_block")).drop("_place", "_own", "_block")
