"""Rounding of doubles on their exact binary value, as Python's round() and JavaScript's toFixed() do."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lantern.functions.text import col

SPLIT = float((1 << 27) + 1)


def exact_round(value: Column | str, digits: int, ties: str = "even") -> Column:
    """``value`` to ``digits`` decimals, ties to even or up.

    Spark's round and bround work on the shortest decimal that prints the value, so that 2.675, which
    is below its name, becomes 2.68. Here the value is split into two halves of 26 bits; their products
    with the power of ten are exact, and so is the remainder that decides.
    """
    x = col(value)
    scale = F.lit(float(10**digits))
    size = F.abs(x)
    high = size * SPLIT - (size * SPLIT - size)
    low = size - high
    whole = F.floor(size * scale).cast("double")
    # how far the part after ``whole`` is above one half: exact near zero, where it decides
    above = (high * scale - whole - 0.5) + low * scale
    up = above >= 0 if ties == "up" else (above > 0) | ((above == 0) & (whole % 2 == 1))
    rounded = F.signum(x) * (whole + F.when(up, 1.0).otherwise(0.0)) / scale
    # from here on neighbouring doubles are at least one step of the last decimal apart
    return F.when(size * scale >= float(1 << 53), x).otherwise(rounded)


def fixed(value: Column | str, digits: int, ties: str = "even") -> Column:
    """The rounded value as text with that many decimals."""
    return F.format_string(f"%.{digits}f", exact_round(value, digits, ties))
