"""Near copies by the Jaccard similarity of five-word shingles: candidates by the fingerprints and the grid of
``simhash`` and, beyond the few bits that these reach, by MinHash; each candidate is compared exactly.

Two texts are near copies if they share at least SIMILARITY of their distinct shingles, and a class is what
is connected by such pairs. Words and shingles are those of ``simhash``, but for the width.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lantern.llm import simhash
from lantern.llm.components import components
from lantern.llm.texts import keyed, map_texts, slices
from lantern.session import durable

SHINGLE = 5
SIMILARITY = 0.8
# 32 buckets of four least hashes: a pair at a similarity of 0.8 shares none of them once in 20 million
BUCKETS, ROWS = 32, 4
# shingles that meet all hash functions at a time
CHUNK = 2048
# a pair goes on to the exact comparison if so many of the 128 least hashes agree (in eight bits each): at a
# similarity of 0.8 fewer do once in 40 million, at one of 0.45 so many do once in 1000
AGREEING = 76
# texts of a bucket of several classes that are met pair by pair as rows; larger ones are compared in
# blocks of so many bytes of shingles
CELL, BLOCK_BYTES = 32, 8 << 20


def hashes_of(text: str, width: int) -> Iterator:
    """The 64-bit hashes of the shingles, repeats included, in blocks; none for a text without words."""
    import numpy as np
    from xxhash import xxh64_intdigest

    for shingles in simhash.shingle_blocks(text.encode().lower(), width):
        yield np.array([xxh64_intdigest(s, simhash.SEED) for s in shingles], np.uint64)


def words_hash(text: str) -> int:
    """One signed 64-bit number for all texts of the same words."""
    from xxhash import xxh3_64

    made = xxh3_64(seed=simhash.SEED)
    for words in simhash.word_blocks(text.encode().lower()):
        if words:
            made.update(b" ".join(words) + b" ")
    number = made.intdigest()
    return number - (1 << 64) if number >> 63 else number


def sketches(docs: DataFrame, key: str, text: str, width: int) -> DataFrame:
    """``key``, ``fp`` (one number for the words), ``print`` (the fingerprint of operator 3 over these shingles),
    ``buckets`` and ``lanes`` (eight bits of each least hash) of every row; no buckets and lanes without words."""

    def rows() -> Callable:
        import numpy as np

        draw = np.random.default_rng(simhash.SEED)
        factors = draw.integers(0, 1 << 63, BUCKETS * ROWS, np.uint64) * np.uint64(2) + np.uint64(1)
        shifts = draw.integers(0, 1 << 63, BUCKETS * ROWS, np.uint64)

        def work(value: str) -> tuple:
            least, tally = None, simhash.Tally()
            for hashes in hashes_of(value, width):
                tally.add(hashes)
                for part in np.array_split(hashes, 1 + len(hashes) // CHUNK):
                    if len(part):
                        low = ((part[:, None] * factors + shifts) >> np.uint64(32)).min(axis=0)
                        least = low if least is None else np.minimum(least, low)
            if least is None:
                return words_hash(value), 0, [], b""
            total = np.arange(BUCKETS, dtype=np.uint64)
            for column in least.reshape(BUCKETS, ROWS).T:
                total = (total ^ column) * np.uint64(0x9E3779B97F4A7C15)
                total ^= total >> np.uint64(29)
            return words_hash(value), tally.fingerprint(), total.view(np.int64), (least & np.uint64(255)).astype(np.uint8).tobytes()

        return work

    arrow = pa.schema(
        [("key", pa.int64()), ("fp", pa.int64()), ("print", pa.int64()), ("buckets", pa.list_(pa.int64())), ("lanes", pa.binary())]
    )
    made = keyed(docs, key, text).withColumn("key", F.col("key").cast("bigint"))
    schema = "key bigint, fp bigint, print bigint, buckets array<bigint>, lanes binary"
    return map_texts(made, rows, schema, arrow).withColumnRenamed("key", key)


def shingle_sets(docs: DataFrame, key: str, text: str, width: int) -> DataFrame:
    """``key``, ``fp`` and ``shingles`` (the sorted distinct hashes as bytes) of every row."""

    def rows() -> Callable:
        import numpy as np

        def work(value: str) -> tuple:
            blocks = [np.unique(b) for b in hashes_of(value, width)]
            return words_hash(value), np.unique(np.concatenate(blocks)).tobytes() if blocks else b""

        return work

    arrow = pa.schema([("key", pa.int64()), ("fp", pa.int64()), ("shingles", pa.binary())])
    made = keyed(docs, key, text).withColumn("key", F.col("key").cast("bigint"))
    return map_texts(made, rows, "key bigint, fp bigint, shingles binary", arrow)


def alike(pairs: DataFrame, lanes: DataFrame) -> DataFrame:
    """The pairs ``a``, ``b`` of which at least ``AGREEING`` lanes agree: 256 bytes a pair decide."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        for batch in batches:
            one, two = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8) for c in ("la", "lb"))
            same = (one == two).reshape(batch.num_rows, BUCKETS * ROWS).sum(axis=1)
            yield batch.select(["a", "b"]).filter(pa.array(same >= AGREEING))

    one = lanes.select(F.col("fp").alias("a"), F.col("lanes").alias("la"))
    two = lanes.select(F.col("fp").alias("b"), F.col("lanes").alias("lb"))
    return pairs.join(one, "a").join(two, "b").select("a", "b", "la", "lb").mapInArrow(run, "a bigint, b bigint")


def similar(pairs: DataFrame, lanes: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs ``a``, ``b`` whose shingles have at least that Jaccard similarity; the sets of a pair come
    along only if its lanes agree."""
    pairs = alike(pairs, lanes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        for batch in batches:
            for part in slices(batch, "sb"):
                keep = []
                for x, y in zip(part.column("sa").to_pylist(), part.column("sb").to_pylist()):
                    one, two = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                    both = len(np.intersect1d(one, two, assume_unique=True))
                    keep.append(both >= similarity * (len(one) + len(two) - both))
                yield part.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    one = sets.select(F.col("fp").alias("a"), F.col("shingles").alias("sa"))
    two = sets.select(F.col("fp").alias("b"), F.col("shingles").alias("sb"))
    # sizes alone rule out what cannot be so similar, before the second set comes along
    near = F.least(F.length("sa"), F.length("sb")) >= F.lit(similarity) * F.greatest(F.length("sa"), F.length("sb"))
    return pairs.join(one, "a").join(two, "b").where(near).select("a", "b", "sa", "sb").mapInArrow(run, "a bigint, b bigint")


def block_pairs(similarity: float) -> Callable[[pa.Table], pa.Table]:
    """Of the texts of one or two blocks of a bucket pairs of different classes that are near copies: a pair that
    is found makes one class of two, so they connect what all such pairs do and are fewer than the texts. A
    pair is compared in the least of the crowded buckets that it shares, and in no other."""

    def run(texts: pa.Table) -> pa.Table:
        import numpy as np

        fps, roots, blocks = (texts.column(c).to_numpy() for c in ("fp", "root", "block"))
        roots = roots.copy()
        bucket, several = texts.column("bucket")[0].as_py(), texts.column("one")[0] != texts.column("two")[0]
        lanes = np.frombuffer(b"".join(texts.column("lanes").to_pylist()), np.uint8).reshape(len(fps), -1)
        sets = [np.frombuffer(s, np.uint64) for s in texts.column("shingles").to_pylist()]
        sizes = np.array([len(s) for s in sets])
        shared = [set(b) for b in texts.column("shared").to_pylist()]
        kinds, counts = np.unique(roots, return_counts=True)
        # a pair of two classes has a text outside the largest one
        largest = roots == kinds[counts.argmax()]
        found = []
        for x in np.flatnonzero(~largest).tolist():
            near = (roots != roots[x]) & (largest | (fps > fps[x]))
            near &= np.minimum(sizes, sizes[x]) >= similarity * np.maximum(sizes, sizes[x])
            if several:
                near &= blocks != blocks[x]
            at = np.flatnonzero(near)
            at = at[(lanes[at] == lanes[x]).sum(axis=1) >= AGREEING]
            for y in at.tolist():
                if roots[y] != roots[x] and min(shared[x] & shared[y]) == bucket:
                    both = len(np.intersect1d(sets[x], sets[y], assume_unique=True))
                    if both >= similarity * (sizes[x] + sizes[y] - both):
                        found.append((int(fps[x]), int(fps[y])))
                        roots[roots == roots[y]] = roots[x]
        one, two = zip(*found) if found else ((), ())
        return pa.table({"a": pa.array(one, pa.int64()), "b": pa.array(two, pa.int64())})

    return run


def similar_in_blocks(crowded: DataFrame, lanes: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """What connects all that ``similar`` finds among the pairs of different classes of crowded buckets (``bucket``, ``fp``,
    ``root``), without a row for each pair.

    A bucket's texts are dealt to blocks of about ``BLOCK_BYTES``, and each two blocks meet in one call: a
    text crosses the shuffle once for each block of its bucket, and a task holds two blocks.
    """
    shared = crowded.groupBy(F.col("fp").alias("text")).agg(F.collect_list("bucket").alias("shared"))
    held = crowded.join(sets, "fp").join(lanes, "fp")
    sizes = held.groupBy(F.col("bucket").alias("of")).agg(F.ceil(F.sum(F.length("shingles").cast("bigint")) / BLOCK_BYTES).cast("int").alias("blocks"))
    held = held.join(shared, held["fp"] == shared["text"]).join(sizes, held["bucket"] == sizes["of"])
    placed = held.withColumn("block", F.pmod(F.xxhash64("fp"), "blocks").cast("int"))
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    placed = placed.select(
        "bucket", F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two"), "block", "fp", "root", "shared", "lanes", "shingles"
    )
    return placed.groupBy("bucket", "one", "two").applyInArrow(block_pairs(similarity), "a bigint, b bigint")


def by_fingerprint(one_each: DataFrame) -> DataFrame:
    """Candidates ``a``, ``b`` of operator 3: the texts of a fingerprint beside the smallest of them, and those
    smallest ones of the fingerprints that its segment-popcount grid links. Rows grow with the texts."""
    worded = one_each.where(F.size("buckets") > 0)
    groups = durable(worded.groupBy("print").agg(F.min("fp").alias("hub")))
    same = worded.join(groups, "print").where("fp <> hub").select(F.col("hub").alias("a"), F.col("fp").alias("b"))
    linked = simhash.near_links(groups.select(F.col("print").alias("fp")))
    one = groups.select(F.col("print").alias("a"), F.col("hub").alias("ha"))
    two = groups.select(F.col("print").alias("b"), F.col("hub").alias("hb"))
    near = linked.join(one, "a").join(two, "b").select(F.least("ha", "hb").alias("a"), F.greatest("ha", "hb").alias("b"))
    return same.union(near)


def links(docs: DataFrame, made: DataFrame, distinct: DataFrame, key: str, text: str, width: int, similarity: float) -> DataFrame:
    """Edges ``a``, ``b`` that connect whatever texts are connected by pairs of at least ``similarity``.

    Texts that operator 3 links by their fingerprints are compared, and a bucket's texts with its smallest one. What
    then is left in a bucket of texts of several classes is compared across the classes: pairs within a class would
    connect nothing more. Up to ``CELL`` texts meet pair by pair, more in blocks, which join their classes as they
    go, so rows grow with the texts.
    """
    one_each = durable(made.select("fp", "print", "buckets", "lanes").dropDuplicates(["fp"]))
    lanes = one_each.select("fp", "lanes")
    cells = one_each.select("fp", F.explode("buckets").alias("bucket"))
    sizes = cells.groupBy("bucket").agg(F.count(F.lit(1)).alias("members"), F.min("fp").alias("hub"))
    shared = durable(cells.join(sizes.where("members > 1"), "bucket").select("bucket", "hub", "fp"))
    printed = durable(by_fingerprint(one_each))
    involved = shared.select("fp").union(printed.select(F.explode(F.array("a", "b")))).distinct().join(distinct.select("fp", "first"), "fp")
    rows = shingle_sets(docs, key, text, width)
    sets = rows.join(
        involved.withColumnRenamed("fp", "node"), (rows["fp"] == F.col("node")) & rows["key"].eqNullSafe(F.col("first")), "left_semi"
    )
    sets = durable(sets.select("fp", "shingles").dropDuplicates(["fp"]))
    star = shared.where("hub <> fp").select(F.col("hub").alias("a"), F.col("fp").alias("b"))
    star = star.union(printed).distinct()
    near = durable(similar(star, lanes, sets, similarity))
    roots = components(near)
    rooted = shared.join(roots, shared["fp"] == roots["node"], "left").select("bucket", "fp", F.coalesce("root", "fp").alias("root"))
    parts = rooted.groupBy("bucket", "root").agg(F.count(F.lit(1)).alias("n"))
    mixed = parts.groupBy("bucket").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("roots")).where("roots > 1")
    left = durable(rooted.join(mixed, "bucket"))
    ahead = left.agg(F.count(F.lit(1)), F.min("n"), F.max("n")).first()
    # no plan is made for what is not there
    if ahead[0] and ahead[1] <= CELL:
        few = left.where(F.col("n") <= CELL)
        across = few.select("bucket", F.col("fp").alias("a"), F.col("root").alias("ra")).join(
            few.select("bucket", F.col("fp").alias("b"), F.col("root").alias("rb")), "bucket"
        )
        across = across.where("a < b AND ra <> rb").select("a", "b").distinct()
        near = near.union(similar(across, lanes, sets, similarity))
    if ahead[0] and ahead[2] > CELL:
        crowded = left.where(F.col("n") > CELL).select("bucket", "fp", "root")
        near = near.union(similar_in_blocks(crowded, lanes, sets, similarity))
    return near


def classes(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = SHINGLE, similarity: float = SIMILARITY) -> DataFrame:
    """``key``, ``fp`` and ``component_id`` (the smallest key of the class) of every row of ``docs``."""
    made = durable(sketches(docs, key, text, width))
    linked = lambda distinct: links(docs, made, distinct, key, text, width, similarity)
    return simhash.classes(made.select(key, "fp"), key, linked)


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = SHINGLE, similarity: float = SIMILARITY) -> DataFrame:
    """``docs`` with the row of the smallest key of each class; rows without a key as in ``simhash.keep_one``."""
    return simhash.kept(docs, classes(docs, key, text, width, similarity), key)
