"""Text expressions shared by the scorers, builders and tokenisers."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that str.strip() and str.split() treat as white space.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
SPACE_CLASS = (
    r"\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
# Unicode word characters: \w is ASCII-only in Java's regular expressions.
WORD = r"[\p{L}\p{N}_]+"


# bytes of text, and words of arrays, that a function of Python holds as objects at a time
SLICE_BYTES = 4 << 20
SLICE_WORDS = 1 << 17


def in_slices(columns: Sequence[pa.Array], limit: int) -> Iterator[list[list]]:
    """Runs of rows of an Arrow batch as lists, one per column, whose texts (or arrays) are about ``limit``
    bytes (or elements) together at most, so that a batch of long rows is never whole in Python objects."""
    rows, start, held = len(columns[0]), 0, 0
    sizes = [0] * rows
    for c in columns:
        if not pa.types.is_integer(c.type):
            length = pc.list_value_length(c) if pa.types.is_list(c.type) else pc.binary_length(c)
            sizes = [a + b for a, b in zip(sizes, length.fill_null(0).to_pylist())]
    for row, size in enumerate(sizes):
        if held and held + size > limit:
            yield [c.slice(start, row - start).to_pylist() for c in columns]
            start, held = row, 0
        held += size
    if start < rows:
        yield [c.slice(start).to_pylist() for c in columns]


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Both ends trimmed of all white space, not of blanks only."""
    return F.btrim(col(c), F.lit(WHITE_SPACE))


def words(c: Column | str) -> Column:
    """Lower-cased word tokens in order."""
    return F.regexp_extract_all(F.lower(col(c)), F.lit(WORD), F.lit(0))


def fields(c: Column | str) -> Column:
    """Pieces between white space, none of them empty; an empty text has no pieces."""
    return F.regexp_extract_all(col(c), F.lit(f"[^{SPACE_CLASS}]+"), F.lit(0))


def numbered(low: Column, high: Column) -> Column:
    """``low..high`` as an array, empty when high < low (``sequence`` would count down)."""
    return F.when(high >= low, F.sequence(low, high)).otherwise(
        F.array().cast("array<int>")
    )


def md5_order(seed: int, *parts: Column | str) -> Column:
    """Seeded pseudo-random order as a BIGINT that every SQL engine with md5 can reproduce."""
    text = F.concat_ws(":", F.lit(str(seed)), *[col(p).cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")
