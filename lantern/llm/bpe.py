"""Byte-level BPE encoding and decoding with a local rank file (operator 7).

The tiktoken library does the merges. Long texts are cut first where the splitting pattern is certain
to end a match, so that its regular expression never sees more than a piece of bounded size.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lantern.llm.texts import keyed, map_texts

# The characters of Unicode's White_Space property, as \s has them in the splitting pattern.
WHITE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"

PIECE = 1 << 16


def pieces(text: str, size: int = PIECE) -> Iterator[tuple[str, bool]]:
    """``text`` cut into pieces, each with whether it is one match of the pattern as a whole.

    A match never goes from a character that is not white space into white space, from an ASCII letter
    into an ASCII character that is none, or from an ASCII digit into one that is none; and no match
    looks back. So a cut there changes nothing. A run of white space up to the last one before a word
    is a match by itself: longer runs than ``size`` skip the pattern, which would recurse into them.
    A stretch without any such place stays whole.
    """
    if len(text) <= size:
        if text:
            yield text, False
        return
    run = re.compile(f"[{WHITE}]{{{max(size, 2)},}}")
    cut = re.compile(
        f"(?<=[^{WHITE}])(?=[{WHITE}])|(?<=[A-Za-z])(?=[\\x00-@\\[-`{{-\\x7f])|(?<=[0-9])(?=[\\x00-/:-\\x7f])"
    )
    start = 0
    while start < len(text):
        found = run.search(text, start)
        stop = found.start() if found else len(text)
        while stop - start > size:
            place = cut.search(text, start + size, stop)
            if not place or place.start() >= stop:
                break
            yield text[start : place.start()], False
            start = place.start()
        if stop > start:
            yield text[start:stop], False
        if not found:
            return
        start = found.end() if found.end() == len(text) else found.end() - 1
        yield text[stop:start], True


def coder(ranks: bytes, pattern: str):
    """Two tiktoken encodings without special tokens from the content of a rank file: with the splitting
    pattern, and with one that takes a whole piece as a single match."""
    import tiktoken

    table = {base64.b64decode(a): int(b) for a, b in (line.split() for line in ranks.splitlines() if line)}
    return tuple(
        tiktoken.Encoding(name, pat_str=split, mergeable_ranks=table, special_tokens={})
        for name, split in (("split", pattern), ("whole", "(?s:.+)"))
    )


def encode(encodings: tuple, text: str) -> list[int]:
    """Ids of the whole text; equal to ``encode_ordinary`` wherever that ends."""
    splitting, whole = encodings
    if len(text) <= PIECE:
        return splitting.encode_ordinary(text)
    ids: list[int] = []
    for piece, single in pieces(text):
        ids += (whole if single else splitting).encode_ordinary(piece)
    return ids


def read_ranks(path: str) -> bytes:
    """The rank file (a vocabulary, under a megabyte), read once on the driver and sent to the tasks."""
    with open(path, "rb") as file:
        return file.read()


def _with_encoding(spark: SparkSession, path: str, pattern: str, work: Callable) -> Callable:
    sent = spark.sparkContext.broadcast((read_ranks(path), pattern))

    def rows() -> Callable:
        encodings = coder(*sent.value)
        return lambda value: work(encodings, value)

    return rows


def tokenise(docs: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``ids`` (array of int) and ``decoded`` (the bytes that the ids stand for) of every text.

    Null and empty texts have no ids. Repeated rows are encoded each by itself, extra columns are left
    out, an empty table gives an empty table. Row-local: nothing is shuffled.
    """
    import numpy as np

    def work(encodings: tuple, value: str) -> tuple:
        ids = encode(encodings, value)
        return np.asarray(ids, np.int32), encodings[0].decode_bytes(ids)

    arrow = pa.schema([("key", pa.int64()), ("ids", pa.list_(pa.int32())), ("decoded", pa.binary())])
    made = map_texts(
        keyed(docs, key, text).withColumn("key", F.col("key").cast("bigint")),
        _with_encoding(docs.sparkSession, path, pattern, work),
        "key bigint, ids array<int>, decoded binary",
        arrow,
    )
    return made.withColumnRenamed("key", key)


def digests(docs: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """As :func:`tokenise`, with the ids as little-endian unsigned 32-bit numbers in one binary ``packed``
    (for hashing or for writing id files), and ``n_tokens``."""
    import numpy as np

    def work(encodings: tuple, value: str) -> tuple:
        ids = encode(encodings, value)
        return len(ids), np.asarray(ids, "<u4").tobytes(), encodings[0].decode_bytes(ids)

    arrow = pa.schema(
        [("key", pa.int64()), ("n_tokens", pa.int64()), ("packed", pa.binary()), ("decoded", pa.binary())]
    )
    made = map_texts(
        keyed(docs, key, text).withColumn("key", F.col("key").cast("bigint")),
        _with_encoding(docs.sparkSession, path, pattern, work),
        "key bigint, n_tokens bigint, packed binary, decoded binary",
        arrow,
    )
    return made.withColumnRenamed("key", key)


def op7_byte_bpe(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    """Every document encoded and decoded; digests of ids and bytes."""
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    made = digests(docs, path or public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    return made.select(
        "doc_id",
        "n_tokens",
        F.sha2("packed", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
