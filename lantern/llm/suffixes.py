"""Exact removal of repeated 50-byte passages by suffix sorting (operator 8).

Only passages that can repeat are sorted. Every 50-byte window has an anchor: the 16-byte string in it with
the least hash. Equal windows have equal anchors, so an anchor that one document alone has rules out its
windows, and windows are compared among those of their anchor. What is left goes to shards by anchor; a
shard's pieces are suffix-sorted by external induced sorting, and runs of suffixes with a common prefix of
50 bytes give each window the smallest document that has it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lantern.llm import induced
from lantern.session import durable

WINDOW = 50
GRAM = 16
# text of one block of documents, pieces of one suffix sort, windows of one piece, bytes hashed at a time
BLOCK_BYTES = 16 << 20
SHARD_BYTES = 2 << 20
PIECE_WINDOWS = 64
CHUNK = 1 << 20
LAST = (1 << 63) - 1
# texts with more copies than this, or than a millionth of all rows, are dealt out by document
HOT_COPIES, HOT_TEXTS = 1_000, 1_000_000


def anchored(data: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """First window, last window and anchor of each run of windows that share their anchor.

    Long texts go in chunks and long runs in pieces: windows may be cut into runs anywhere.
    """
    span = WINDOW - GRAM + 1
    for start in range(0, len(data) - WINDOW + 1, CHUNK):
        part = data[start : start + CHUNK + WINDOW - 1]
        grams, power, width = part.astype(np.uint64) + np.uint64(1), np.uint64(0x9E3779B97F4A7C15), 1
        with np.errstate(over="ignore"):
            while width < GRAM:
                grams = grams[:-width] * power + grams[width:]
                power, width = power * power, 2 * width
            grams = (grams ^ (grams >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        grams ^= grams >> np.uint64(29)
        least, width = grams, 1
        while 2 * width <= span:
            least, width = np.minimum(least[:-width], least[width:]), 2 * width
        if span > width:
            least = np.minimum(least[: len(least) - (span - width)], least[span - width :])
        first = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
        last = np.append(first[1:], len(least)) - 1
        if len(first) and (last - first).max() >= PIECE_WINDOWS:
            counts = (last - first) // PIECE_WINDOWS + 1
            offset = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
            last = np.minimum(np.repeat(first, counts) + (offset + 1) * PIECE_WINDOWS - 1, np.repeat(last, counts))
            first = np.repeat(first, counts) + offset * PIECE_WINDOWS
        yield first + start, last + start, least[first].view(np.int64)


def as_bytes(text: pa.Scalar) -> np.ndarray:
    return np.frombuffer(text.as_buffer() or b"", np.uint8)


def digest(piece) -> bytes:
    return hashlib.blake2b(piece, digest_size=16).digest()


def first_copies(docs: pa.RecordBatch | pa.Table) -> Iterator[tuple[int, np.ndarray]]:
    """(document, bytes) of each distinct text, with the smallest document that has it; texts that are
    known to have a smaller one elsewhere, and those without a window, are left out."""
    first: dict[bytes, int] = {}
    columns = (docs.column("doc_id").to_pylist(), docs.column("earliest").to_pylist(), docs.column("text"))
    for doc, earliest, text in zip(*columns):
        data = as_bytes(text)
        if doc <= earliest and len(data) >= WINDOW:
            whole = data.tobytes()
            first[whole] = min(doc, first.get(whole, doc))
    for whole, doc in first.items():
        yield doc, np.frombuffer(whole, np.uint8)


ANCHORS = pa.schema([("anchor", pa.int64()), ("block", pa.int32()), ("several", pa.bool_())])
PIECES = pa.schema([("anchor", pa.int64()), ("block", pa.int32()), ("piece", pa.binary()), ("least", pa.int64()), ("most", pa.int64())])
FOUND = pa.schema([("block", pa.int32()), ("anchor", pa.int64()), ("piece", pa.binary()), ("least", pa.binary())])
RESULT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept", pa.binary())])


def block_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct anchors of each block, and whether several of its distinct texts have one."""
    found: dict[int, list] = {}
    seen: set[bytes] = set()
    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("block", "doc_id", "earliest"))
        for block, doc, earliest, text in zip(*columns, batch.column("text")):
            data = as_bytes(text)
            if doc > earliest or len(data) < WINDOW or (mark := digest(data)) in seen:
                continue
            seen.add(mark)
            runs = [anchors for _, _, anchors in anchored(data)]
            found.setdefault(block, []).append(np.unique(np.concatenate(runs)))
    for block, arrays in found.items():
        anchors, counts = np.unique(np.concatenate(arrays), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(anchors), pa.array(np.full(len(anchors), block, np.int32)), pa.array(counts > 1)], schema=ANCHORS)


def repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(block, anchor) of the anchors that more than one document has; all rows of an anchor are here."""
    parts = [(b.column("anchor").to_numpy(), b.column("block").to_numpy(), b.column("several").to_numpy(zero_copy_only=False)) for b in batches]
    if not parts:
        return
    anchors, blocks, several = (np.concatenate(x) for x in zip(*parts))
    _, place, counts = np.unique(anchors, return_inverse=True, return_counts=True)
    often = counts > 1
    often[place[several]] = True
    keep = often[place]
    yield pa.RecordBatch.from_arrays([pa.array(blocks[keep]), pa.array(anchors[keep])], names=["block", "anchor"])


def runs_of(data: np.ndarray, wanted: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """The runs whose anchor is wanted (a sorted array)."""
    if not len(wanted):
        return
    for first, last, anchors in anchored(data):
        hit = np.flatnonzero(wanted[np.minimum(np.searchsorted(wanted, anchors), len(wanted) - 1)] == anchors)
        yield from zip(first[hit].tolist(), last[hit].tolist(), anchors[hit].tolist())


def block_pieces(docs: pa.Table, anchors: pa.Table) -> pa.Table:
    """The distinct pieces of a block's documents around repeated anchors, each with the smallest and the
    largest document that has it."""
    wanted = np.unique(anchors.column("anchor").to_numpy())
    found: dict[tuple, list] = {}
    if len(wanted):
        for doc, data in first_copies(docs):
            whole = data.tobytes()
            for first, last, anchor in runs_of(data, wanted):
                piece = (anchor, whole[first : last + WINDOW])
                seen = found.get(piece)
                if seen is None:
                    found[piece] = [doc, doc]
                elif doc < seen[0]:
                    seen[0] = doc
                elif doc > seen[1]:
                    seen[1] = doc
    block = docs.column("block")[0].as_py() if len(docs) else 0
    rows = list(found.items())
    return pa.Table.from_arrays(
        [
            pa.array([k[0] for k, _ in rows], pa.int64()),
            pa.array([block] * len(rows), pa.int32()),
            pa.array([k[1] for k, _ in rows], pa.binary()),
            pa.array([v[0] for _, v in rows], pa.int64()),
            pa.array([v[1] for _, v in rows], pa.int64()),
        ],
        schema=PIECES,
    )


def least_documents(pieces: list[bytes], least: np.ndarray) -> list[np.ndarray]:
    """For every window of every piece the smallest document that has these 50 bytes in any piece."""
    lengths = np.array([len(p) for p in pieces])
    # no byte of UTF-8 is 255, so one more than a byte fits and 0 is free to end the pieces
    text = np.frombuffer(b"\xff".join(pieces) + b"\xff", np.uint8) + np.uint8(1)
    order, prefixes = induced.sort_suffixes(text, WINDOW)
    starts = np.concatenate([[0], np.cumsum(lengths + 1)[:-1]])
    piece = np.searchsorted(starts, order, side="right") - 1
    group = np.cumsum(prefixes < WINDOW) - 1
    # a suffix of fewer bytes than a window has no such common prefix with any other: it is a group alone
    smallest = np.full(int(group[-1]) + 1, LAST)
    np.minimum.at(smallest, group, least[piece])
    per_place = np.empty(len(text), np.int64)
    per_place[order] = smallest[group]
    return [per_place[s : s + n - WINDOW + 1] for s, n in zip(starts, lengths)]


def first_windows(shard: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorts the pieces of whole anchors and says for the pieces of each block which documents have their
    windows first, where that can remove something."""
    rows = pa.Table.from_batches(shard, PIECES).combine_chunks()
    anchors, blocks, docs, most = (rows.column(c).to_numpy() for c in ("anchor", "block", "least", "most"))
    coded = pa.concat_arrays(rows.column("piece").chunks).dictionary_encode()
    piece, distinct = coded.indices.to_numpy(), coded.dictionary
    least = np.full(len(distinct), LAST)
    np.minimum.at(least, piece, docs)
    anchor_of = np.zeros(len(distinct), np.int64)
    anchor_of[piece] = anchors
    # where an anchor has one piece alone there is nothing to sort it among: all its windows have the
    # piece's own documents
    _, kind, kinds = np.unique(anchor_of, return_inverse=True, return_counts=True)
    several = np.flatnonzero(kinds[kind] > 1)
    low, high, windows = least.copy(), least.copy(), {}
    if len(several):
        found = least_documents(distinct.take(pa.array(several)).to_pylist(), least[several])
        flat, starts = np.concatenate(found), np.cumsum([0, *map(len, found[:-1])])
        low[several], high[several] = np.minimum.reduceat(flat, starts), np.maximum.reduceat(flat, starts)
        windows = dict(zip(several.tolist(), found))
    out = np.flatnonzero(low[piece] < most)
    named, place = np.unique(piece[out], return_inverse=True)
    marks = [digest(p) for p in distinct.take(pa.array(named)).to_pylist()]
    said = [(low[c : c + 1] if low[c] == high[c] else windows[c]).tobytes() for c in named.tolist()]
    for at in range(0, len(out), 50_000):
        part, of = out[at : at + 50_000], pa.array(place[at : at + 50_000])
        columns = [pa.array(blocks[part]), pa.array(anchors[part])]
        columns += [pa.array(column, pa.binary()).take(of) for column in (marks, said)]
        yield pa.RecordBatch.from_arrays(columns, schema=FOUND)


def shard_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``first_windows`` of shards of about ``SHARD_BYTES``; rows come in the order of anchors, and an anchor's
    rows stay together."""
    held: list[pa.RecordBatch] = []
    size, last = 0, None
    for batch in batches:
        if not batch.num_rows:
            continue
        batch = pa.RecordBatch.from_arrays(batch.columns, schema=PIECES)
        anchors = batch.column("anchor").to_numpy()
        upto = np.cumsum(np.append(0, pc.binary_length(batch.column("piece")).to_numpy().astype(np.int64)))
        fresh = np.flatnonzero(np.append(last is not None and anchors[0] != last, anchors[1:] != anchors[:-1]))
        start = 0
        while True:
            full = fresh[(fresh >= start) & (size + upto[fresh] - upto[start] >= SHARD_BYTES)]
            if not len(full):
                break
            held.append(batch.slice(start, full[0] - start))
            yield from first_windows(held)
            held, size, start = [], 0, int(full[0])
        held.append(batch.slice(start))
        size += int(upto[-1] - upto[start])
        last = anchors[-1]
    if held:
        yield from first_windows(held)


def block_result(docs: pa.Table, found: pa.Table) -> pa.Table:
    """Every document of a block without the bytes of windows that a smaller document has."""
    wanted = np.unique(found.column("anchor").to_numpy())
    # one number stands for all windows of a piece
    first_of = {
        p: int.from_bytes(w, "little", signed=True) if len(w) == 8 else np.frombuffer(w, np.int64)
        for p, w in zip(found.column("piece").to_pylist(), found.column("least").to_pylist())
    }
    earliest_of = {data.tobytes(): doc for doc, data in first_copies(docs)}
    rows = []
    columns = (docs.column("doc_id").to_pylist(), docs.column("earliest").to_pylist(), docs.column("text"))
    for doc, earliest, text in zip(*columns):
        data = as_bytes(text)
        whole = data.tobytes()
        if len(data) < WINDOW:
            rows.append((doc, len(data), 0, 0, whole))
            continue
        if doc > min(earliest, earliest_of.get(whole, doc)):  # all of it is in an earlier copy
            rows.append((doc, len(data), len(data), 1, b""))
            continue
        begin, end = [], []
        for first, last, _ in runs_of(data, wanted):
            windows = first_of.get(digest(whole[first : last + WINDOW]))
            if windows is None:
                continue
            if isinstance(windows, int):
                if windows < doc:
                    begin.append(first)
                    end.append(last + WINDOW)
                continue
            at = (first + np.flatnonzero(windows < doc)).tolist()
            begin += at
            end += [a + WINDOW for a in at]
        if not begin:
            rows.append((doc, len(data), 0, 0, whole))
            continue
        change = np.zeros(len(data) + 1, np.int32)
        change[begin] += 1
        change[end] -= 1
        gone = np.cumsum(change[:-1]) > 0
        spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
        rows.append((doc, len(data), int(gone.sum()), spans, data[~gone].tobytes()))
    columns = list(zip(*rows)) or [[]] * len(RESULT)
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, RESULT)], schema=RESULT)


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept`` (the remaining bytes) of every row.

    A byte goes if a 50-byte string that covers it also starts in a document with a smaller key; strings
    are judged on the input. Null texts are empty. Rows without a key count as larger than all others and
    not as smaller than each other; rows with equal keys do not remove from each other. Extra columns are
    left out; an empty table gives an empty table.

    The texts are shuffled once, into blocks of about 16 MB that take copies of a text together, so that
    only the first copy is cut up; texts with very many copies are known beforehand (a table of at most a
    million) and dealt out by document. An anchor or piece crosses the next shuffles once per block
    however many of the block's documents have it, and a shard takes whole anchors.
    """
    id_ = F.col(f"`{key}`").cast("bigint")
    rows = docs.select(
        F.coalesce(id_, F.lit(LAST)).alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text")
    )
    seen = rows.agg(F.sum(F.octet_length("text").cast("bigint")).alias("size"), F.count(F.lit(1)).alias("n")).first()
    blocks = max(1, -(-(seen.size or 0) // BLOCK_BYTES))
    mark = F.sha2("text", 256)
    copies = rows.groupBy(mark.alias("mark")).agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n"))
    hot = durable(copies.where(F.col("n") > max(HOT_COPIES, seen.n // HOT_TEXTS)).select("mark", "least"))
    # greatest() is the last key for every row; a mere literal would be moved behind the shuffle in some
    # places and not in others, and the texts would be shuffled once for each
    nowhere = F.greatest("doc_id", F.lit(LAST))
    dealt = rows.select("doc_id", "text", nowhere.alias("earliest"), F.xxhash64("text").alias("home"))
    if not hot.isEmpty():
        dealt = rows.join(F.broadcast(hot), mark == F.col("mark"), "left").select(
            "doc_id",
            "text",
            F.coalesce("least", nowhere).alias("earliest"),
            F.when(F.col("least").isNull(), F.xxhash64("text")).otherwise(F.xxhash64("text", "doc_id")).alias("home"),
        )
    block = F.pmod("home", F.lit(blocks)).cast("int")
    dealt = dealt.select("doc_id", "text", "earliest", block.alias("block")).repartition(blocks, "block")
    anchors = dealt.mapInArrow(block_anchors, "anchor bigint, block int, several boolean")
    twice = anchors.repartition("anchor").mapInArrow(repeated, "block int, anchor bigint")
    pieces = (
        dealt.groupBy("block")
        .cogroup(twice.groupBy("block"))
        .applyInArrow(lambda _, left, right: block_pieces(left, right), "anchor bigint, block int, piece binary, least bigint, most bigint")
    )
    found = (
        pieces.repartition("anchor")
        .sortWithinPartitions("anchor")
        .mapInArrow(shard_windows, "block int, anchor bigint, piece binary, least binary")
    )
    made = (
        dealt.groupBy("block")
        .cogroup(found.groupBy("block"))
        .applyInArrow(lambda _, left, right: block_result(left, right), "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary")
    )
    return made.withColumn("doc_id", F.nullif("doc_id", F.lit(LAST)))


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without passages that an earlier one has."""
    made = remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return made.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
