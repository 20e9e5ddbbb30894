"""SimHash near-duplicates by a segment-popcount embedding (operator 3).

A fingerprint's 64 bits are cut into 32 segments of two, and each segment is mapped to its number of
ones. The Manhattan distance of two such vectors is at most the number of differing bits, so a range
join under it finds every pair of near fingerprints; the pairs found are then compared exactly.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from itertools import combinations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lantern.llm.components import components
from lantern.llm.texts import keyed, map_texts
from lantern.session import durable

SHINGLE = 3
SEED = 42
# fingerprints that differ in so many bits are linked; the way round crowded cells is made for two
NEAR_BITS = 2
# the embedding's 32 segments in six bands: at a distance of two at least four bands agree
BANDS = (5, 5, 5, 5, 6, 6)
# a cell with more fingerprints than this is not joined pair by pair
CELL = 64

BLOCK = 1 << 20
SPACE = re.compile(rb"[\x09-\x0d\x20]")


def word_blocks(data: bytes, size: int = BLOCK) -> Iterator[list[bytes]]:
    """The words of ``data`` in blocks of about ``size`` bytes, so that long texts take bounded memory."""
    start = 0
    while start < len(data):
        space = SPACE.search(data, start + size)
        stop = space.start() if space else len(data)
        yield data[start:stop].split()
        start = stop


def shingle_blocks(data: bytes, width: int = SHINGLE) -> Iterator[list[bytes]]:
    """Shingles of ``width`` words, repeats included; the whole sequence where there are fewer words."""
    carried: list[bytes] = []
    short = True
    for words in word_blocks(data):
        words = carried + words
        if len(words) >= width:
            short = False
            line = b" ".join(words)
            starts, at = [], 0
            for word in words:
                starts.append(at)
                at += len(word) + 1
            starts.append(at)
            yield [line[s : e - 1] for s, e in zip(starts, starts[width:])]
        carried = words[1 - width :]
    if short and carried:
        yield [b" ".join(carried)]


class Tally:
    """Of the hashes seen so far, how many have each bit."""

    def __init__(self) -> None:
        import numpy as np

        self.ones, self.total = np.zeros(64, np.int64), 0

    def add(self, hashes) -> None:
        import numpy as np

        for part in np.array_split(hashes, 1 + len(hashes) // 16384):
            bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            self.ones += bits.sum(axis=0, dtype=np.int64)
        self.total += len(hashes)

    def fingerprint(self) -> int:
        """The bits that over half of the hashes have, as a signed number; zero without hashes."""
        import numpy as np

        return int(np.packbits(2 * self.ones > self.total, bitorder="little").view("<i8")[0]) if self.total else 0


def fingerprint(text: str) -> int:
    """The 64-bit fingerprint; zero for a text without words."""
    import numpy as np
    from xxhash import xxh64_intdigest

    tally = Tally()
    for shingles in shingle_blocks(text.encode().lower()):
        tally.add(np.array([xxh64_intdigest(s, SEED) for s in shingles], "<u8"))
    return tally.fingerprint()


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and ``fp`` (signed 64-bit) of every row; null and empty texts have zero. Row-local."""

    def rows() -> Callable:
        return lambda value: (fingerprint(value),)

    arrow = pa.schema([("key", pa.int64()), ("fp", pa.int64())])
    rows_of = keyed(docs, key, text).withColumn("key", F.col("key").cast("bigint"))
    return map_texts(rows_of, rows, "key bigint, fp bigint", arrow).withColumnRenamed("key", key)


def embedding(fp: Column) -> Column:
    """The number of ones in each two-bit segment, written as 00, 01 or 11, so that the Manhattan
    distance of two embeddings is the number of bits in which they differ."""
    low, high = F.lit(0x5555555555555555), F.lit(0x5555555555555555 * 2 - (1 << 64))
    any_one = fp.bitwiseOR(F.shiftrightunsigned(fp, 1)).bitwiseAND(low)
    both = fp.bitwiseAND(F.shiftleft(fp, 1)).bitwiseAND(high)
    return any_one.bitwiseOR(both)


def cell_masks() -> list[int]:
    """For each choice of four bands the bits of the embedding that they cover, as signed numbers."""
    masks, at = [], 0
    for width in BANDS:
        masks.append(((1 << 2 * width) - 1) << at)
        at += 2 * width
    chosen = [sum(some) for some in combinations(masks, len(BANDS) - NEAR_BITS)]
    return [m - (1 << 64) if m >> 63 else m for m in chosen]


def near_links(distinct: DataFrame) -> DataFrame:
    """Edges ``a``, ``b`` that connect whatever fingerprints (column ``fp``, each once) are connected by
    steps of two bits or fewer. Every edge is such a step.

    Grid: a fingerprint lies in one cell for each choice of four bands; near ones share a cell, as their
    embeddings cannot differ in more than two bands. Within a cell pairs are cut by Manhattan distance
    and then compared bit by bit. A crowded cell would make pairs with the square of its size: its
    members instead meet at the points one bit away. Two fingerprints are near exactly if such points of
    theirs coincide, a point has at most 65 fingerprints around it, and each is linked with the
    smallest of them. No link is lost, and the rows grow with the number of fingerprints.
    """
    embedded = distinct.select("fp", embedding(F.col("fp")).alias("embedded"))
    cells = embedded.select(
        "fp",
        "embedded",
        F.posexplode(F.array(*[F.col("embedded").bitwiseAND(F.lit(mask)) for mask in cell_masks()])).alias("bands", "cell"),
    )
    sizes = cells.groupBy("bands", "cell").agg(F.count(F.lit(1)).alias("members"))
    shared = durable(cells.join(sizes.where("members > 1"), ["bands", "cell"]))
    few = shared.where(F.col("members") <= CELL)
    one = few.select("bands", "cell", F.col("fp").alias("a"), F.col("embedded").alias("ea"))
    two = few.select("bands", "cell", F.col("fp").alias("b"), F.col("embedded").alias("eb"))
    pairs = one.join(
        two,
        (one["bands"] == two["bands"])
        & (one["cell"] == two["cell"])
        & (F.col("a") < F.col("b"))
        & (F.bit_count(F.col("ea").bitwiseXOR(F.col("eb"))) <= NEAR_BITS)
        & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= NEAR_BITS),
    ).select("a", "b")
    crowded = shared.where(F.col("members") > CELL).select("fp").distinct()
    steps = [0, *(1 << i for i in range(63)), -(1 << 63)]
    around = crowded.select("fp", F.explode(F.array(*[F.col("fp").bitwiseXOR(F.lit(s)) for s in steps])).alias("point"))
    hubs = around.groupBy("point").agg(F.min("fp").alias("hub"), F.count(F.lit(1)).alias("n")).where("n > 1")
    met = around.join(hubs, "point").where("fp <> hub").select(F.col("hub").alias("a"), F.col("fp").alias("b"))
    return pairs.union(met).distinct()


def classes(prints: DataFrame, key: str = "doc_id", links: Callable[[DataFrame], DataFrame] = near_links) -> DataFrame:
    """``prints`` (``key``, ``fp``) with ``component_id``, the smallest key reachable over ``links`` of the
    distinct prints (``fp`` and its smallest key ``first``).

    Copies are one fingerprint here, so they make no pairs. Rows without a key count as copies and give
    no id; a class without any key has a null id. ``prints`` is read more than once: keep it on disk.
    """
    distinct = durable(prints.groupBy("fp").agg(F.min(key).alias("first")))
    roots = components(links(distinct))
    linked = distinct.join(roots, distinct["fp"] == roots["node"])
    smallest = linked.groupBy(F.col("root").alias("r")).agg(F.min("first").alias("smallest"))
    named = roots.join(smallest, roots["root"] == smallest["r"]).select("node", "smallest")
    members = distinct.join(named, distinct["fp"] == named["node"], "left").select(
        F.col("fp").alias("member"), F.when(F.col("node").isNull(), F.col("first")).otherwise(F.col("smallest")).alias("component_id")
    )
    return prints.join(members, prints["fp"] == members["member"], "left").select(key, "fp", "component_id")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``fingerprint`` (16 hexadecimal digits) and ``component_id`` of every row of ``docs``.

    Words are what lies between ASCII white space after A-Z are lower-cased, shingles three words with
    repeats. Texts without words (null, empty, blank) share fingerprint zero. Repeated rows stay, each
    with its class; an empty table gives an empty table; extra columns are left out.
    """
    found = classes(durable(fingerprints(docs, key, text)), key)
    return found.select(key, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with the row of the smallest key of each class, all columns as they are.

    Rows without a key stay, as no class can name them. Rows that share a key are taken for one document,
    of which one row stays.
    """
    return kept(docs, classes(durable(fingerprints(docs, key, text)), key), key)


def kept(docs: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """The rows of ``docs`` that ``found`` (``key``, ``component_id``) names as the first of their class."""
    kept = found.where(F.col(key).isNotNull() & (F.col(key) == F.col("component_id")))
    counted = durable(kept.groupBy(F.col(key).alias("kept")).agg(F.count(F.lit(1)).alias("copies")))
    on = docs[key] == counted["kept"]
    whole = docs.join(counted.where("copies = 1"), on, "left_semi").unionByName(docs.where(docs[key].isNull()))
    several = counted.where("copies > 1")
    if several.isEmpty():  # as keys should be: else the texts would cross a shuffle for nothing
        return whole
    return whole.unionByName(docs.join(several, on, "left_semi").dropDuplicates([key]))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The class of every document."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
