"""WARC archives: writing, normalising whole-file gzip streams, reading by an offset index (operator 9).

Archives are written by Spark's own text writer, so they can lie in any store that Spark reaches, and a
lost task leaves no half-written archive. A freshly written archive is one gzip stream over the whole
file, which can only be read from its start. The normaliser inflates such a stream once, writes every
record as a gzip member of its own, and beside the archive an index with each member's offset.
"""

from __future__ import annotations

import base64
import hashlib
import json
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lantern.session import fresh_path

CRLF = "\r\n"

# A text file's lines end with this character. It is also the last byte of a gzip member that holds
# fewer than 2^24 bytes (the top byte of its length), so line after line makes a file of whole members.
NUL = "\x00"
INFLATE = 1 << 20


def base32_sha1(content: Column) -> Column:
    """SHA-1 in upper-case base32 without a prefix, as WARC digests have it."""
    digits, letters = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    whole = F.sha1(content)
    parts = [F.lpad(F.conv(F.substring(whole, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*parts), digits, letters)


def plan_records(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", least: int = 0) -> DataFrame:
    """``key``, ``url``, ``payload``, ``digest`` and ``refers_to``: of pages with equal payloads of at least
    ``least`` bytes the one with the largest key is the response (``refers_to`` null), the others refer
    to it. Rows that repeat the largest key are responses too, as are rows of a payload that has no key
    at all; a null key beside others is a revisit. A null payload is an empty one.
    """
    rows = pages.select(
        F.col(f"`{key}`").cast("bigint").alias("page_id"),
        F.col(f"`{url}`").cast("string").alias("url"),
        F.coalesce(F.col(f"`{html}`"), F.lit("")).alias("payload"),
    ).withColumn("digest", base32_sha1(F.col("payload")))
    # counted in each task first: a payload that a third of the pages share is one row per task here
    newest = rows.groupBy(F.col("digest").alias("same")).agg(
        F.max("page_id").alias("newest"), F.count(F.lit(1)).alias("copies")
    )
    again = (F.octet_length("payload") >= least) & ~F.col("page_id").eqNullSafe(F.col("newest"))
    return rows.join(newest.where("copies > 1"), F.col("digest") == F.col("same"), "left").select(
        "page_id",
        "url",
        "payload",
        "digest",
        F.when(F.col("copies").isNotNull() & again, F.col("newest")).alias("refers_to"),
    )


def record_text(date: str) -> Column:
    """A whole WARC record but for its last line feed, which the text writer adds."""
    uri = F.regexp_replace("url", r"[\x00-\x20]+", "%20")
    name = lambda page: F.concat(F.lit("<urn:page:"), F.coalesce(page.cast("string"), F.lit("null")), F.lit(">"))
    revisit = F.col("refers_to").isNotNull()
    size = F.octet_length("payload")
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
        size.cast("string"),
        F.lit(CRLF + CRLF),
    )
    block = F.octet_length(http) + F.when(revisit, 0).otherwise(size)
    return F.concat(
        F.lit(f"WARC/1.1{CRLF}WARC-Type: "),
        F.when(revisit, "revisit").otherwise("response"),
        F.lit(f"{CRLF}WARC-Record-ID: "),
        name(F.col("page_id")),
        F.lit(f"{CRLF}WARC-Date: {date}{CRLF}WARC-Payload-Digest: sha1:"),
        F.col("digest"),
        F.when(F.col("url").isNull(), F.lit("")).otherwise(F.concat(F.lit(f"{CRLF}WARC-Target-URI: "), uri)),
        F.when(
            revisit,
            F.concat(
                F.lit(f"{CRLF}WARC-Refers-To: "),
                name(F.col("refers_to")),
                F.lit(
                    f"{CRLF}WARC-Profile: "
                    "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
                ),
            ),
        ).otherwise(F.lit("")),
        F.lit(f"{CRLF}Content-Type: application/http;msgtype=response{CRLF}Content-Length: "),
        block.cast("string"),
        F.lit(CRLF + CRLF),
        http,
        F.when(revisit, F.lit("")).otherwise(F.col("payload")),
        F.lit("\r\n\r"),
    )


def write_monolithic(records: DataFrame, path: str, date: str = "2020-01-01T00:00:00Z") -> None:
    """One archive per task, each one gzip stream over all of its records."""
    records.select(record_text(date).alias("value")).write.text(path, compression="gzip")


def inflated(content: bytes) -> Iterator[bytes]:
    """The bytes of a gzip file of one or more members, a chunk at a time."""
    rest = memoryview(content)
    while len(rest):
        stream, done = zlib.decompressobj(31), 0
        feed: bytes | memoryview = b""
        while not stream.eof:
            if not feed:
                if done >= len(rest):
                    raise ValueError("the gzip stream ends early")
                feed = rest[done : done + INFLATE]
                done += len(feed)
            yield stream.decompress(feed, INFLATE)
            feed = stream.unconsumed_tail
        rest = rest[done - len(stream.unused_data) :]


def split_records(chunks: Iterable[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and raw bytes of each record of an uncompressed stream; holds one record at a time."""
    held, source = bytearray(), iter(chunks)

    def more() -> bool:
        chunk = next(source, None)
        if chunk is None:
            return False
        held.extend(chunk)
        return True

    while True:
        while not held.lstrip(b"\r\n") and more():
            pass
        if not held.lstrip(b"\r\n"):
            return
        del held[: len(held) - len(held.lstrip(b"\r\n"))]
        while (end := held.find(b"\r\n\r\n")) < 0:
            if not more():
                raise ValueError("a record's header has no end")
        lines = held[:end].decode("utf-8").split(CRLF)
        fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
        whole = end + 4 + int(fields["content-length"])
        while len(held) < whole:
            if not more():
                raise ValueError("a record's block ends early")
        yield fields, bytes(held[:whole])
        del held[:whole]


def member(record: bytes, level: int) -> bytes:
    """The record as a gzip member whose last byte is zero."""
    squeeze = zlib.compressobj(level, zlib.DEFLATED, 31)
    made = squeeze.compress(record + b"\r\n\r\n") + squeeze.flush()
    if made[-1]:  # 16 MB or more: an empty member after it ends with the length zero
        squeeze = zlib.compressobj(level, zlib.DEFLATED, 31)
        made += squeeze.compress(b"") + squeeze.flush()
    return made


def normalise(spark: SparkSession, source: str, target: str, level: int = 6) -> None:
    """Archives below ``source`` written anew below ``target/kind=warc``, a member per record, with one
    JSON line per record (part, offset, length, id, type, digest) below ``target/kind=index``.

    A stream is inflated once and one record is held at a time; a task holds one archive as it is
    compressed. Archive part-N and index part-N belong together. An empty archive gives no record.
    """
    arrow = pa.schema([("kind", pa.string()), ("seq", pa.int64()), ("value", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, offset, seq, rows, held = TaskContext.get().partitionId(), 0, 0, [], 0
        for batch in batches:
            for content in batch.column("content"):
                for fields, record in split_records(inflated(content.as_buffer())):
                    made = member(record, level)
                    line = {
                        "part": part,
                        "offset": offset,
                        "length": len(made),
                        "id": fields["warc-record-id"],
                        "type": fields["warc-type"],
                        "digest": fields.get("warc-payload-digest"),
                    }
                    rows += [("warc", seq, made[:-1]), ("index", seq, json.dumps(line).encode())]
                    offset, seq, held = offset + len(made), seq + 1, held + len(made)
                    if held > 4 << 20:
                        yield pa.RecordBatch.from_pylist([dict(zip(arrow.names, row)) for row in rows], arrow)
                        rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist([dict(zip(arrow.names, row)) for row in rows], arrow)

    archives = spark.read.format("binaryFile").load(source).select("content")
    # an archive without records and its index, so that both folders are there whatever the source holds
    nothing = zlib.compressobj(level, zlib.DEFLATED, 31).flush()
    ddl = "kind string, seq bigint, value binary"
    bare = spark.createDataFrame([("warc", 0, nothing[:-1]), ("index", 0, b"")], ddl).coalesce(1)
    (
        archives.mapInArrow(run, ddl)
        .unionByName(bare)
        .sortWithinPartitions("kind", "seq")
        .select("kind", F.col("value").cast("string").alias("value"))
        .write.partitionBy("kind")
        .text(target, lineSep=NUL)
    )


def read_indexed(spark: SparkSession, target: str) -> DataFrame:
    """Every record of the normalised archives, each inflated from its own offset: ``page_id``,
    ``record_type``, ``refers_to``, ``payload_bytes``, ``payload_digest``, ``url`` and ``payload`` (null
    for a revisit, whose size and digest are those that its headers give)."""
    entries = (
        spark.read.schema("value string")
        .text(f"{target}/kind=index", lineSep=NUL)
        .select(F.from_json("value", "part int, offset bigint, length bigint").alias("e"))
        .where("e.part IS NOT NULL")
        .groupBy(F.col("e.part").alias("part"))
        .agg(F.collect_list(F.struct("e.offset", "e.length")).alias("members"))
    )
    archives = (
        spark.read.format("binaryFile")
        .load(f"{target}/kind=warc")
        .select(F.regexp_extract("path", r"part-(\d+)", 1).cast("int").alias("part"), "content")
    )
    arrow = pa.schema(
        [
            ("page_id", pa.int64()),
            ("record_type", pa.string()),
            ("refers_to", pa.int64()),
            ("payload_bytes", pa.int64()),
            ("payload_digest", pa.string()),
            ("url", pa.string()),
            ("payload", pa.string()),
        ]
    )

    def page(name: str | None) -> int | None:
        number = (name or "").removeprefix("<urn:page:").removesuffix(">")
        return int(number) if number.lstrip("-").isdigit() else None

    def parsed(data: bytes) -> dict:
        fields, record = next(split_records([zlib.decompressobj(31).decompress(data)]))
        block = record[record.index(b"\r\n\r\n") + 4 :]
        http, _, payload = block.partition(b"\r\n\r\n")
        if fields["warc-type"] == "response":
            digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
            size = len(payload)
        else:
            digest = fields["warc-payload-digest"].removeprefix("sha1:")
            size = int(http.decode().lower().partition("content-length:")[2].split(CRLF)[0])
        return {
            "page_id": page(fields["warc-record-id"]),
            "record_type": fields["warc-type"],
            "refers_to": page(fields.get("warc-refers-to")),
            "payload_bytes": size,
            "payload_digest": digest,
            "url": fields.get("warc-target-uri"),
            "payload": payload.decode() if fields["warc-type"] == "response" else None,
        }

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content, members in zip(batch.column("content"), batch.column("members")):
                data, rows, held = memoryview(content.as_buffer()), [], 0
                for at in members.as_py():
                    rows.append(parsed(data[at["offset"] : at["offset"] + at["length"]]))
                    held += rows[-1]["payload_bytes"]
                    if held > 4 << 20:
                        yield pa.RecordBatch.from_pylist(rows, arrow)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, arrow)

    return archives.join(entries, "part").mapInArrow(
        run,
        "page_id bigint, record_type string, refers_to bigint, payload_bytes bigint, payload_digest string, "
        "url string, payload string",
    )


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page through an archive: written as a whole-file stream, normalised, read by the index."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    streams, members = fresh_path(spark, "warc-streams"), fresh_path(spark, "warc-members")
    write_monolithic(plan_records(pages), streams)
    normalise(spark, streams, members)
    return read_indexed(spark, members).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


OP9_SQL = """
WITH hashed AS (
    SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages
), bits AS (
    SELECT page_id, html, hex, max(page_id) OVER (PARTITION BY hex) AS newest,
        list_transform(range(4), lambda i: ('0x' || substr(hex, 1 + 10 * i, 10))::BIGINT) AS words
    FROM hashed
)
SELECT page_id, octet_length(encode(html)) AS payload_bytes,
    list_aggregate(list_transform(range(32),
        lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((words[1 + k // 8] >> (35 - 5 * (k % 8))) & 31), 1)),
        'string_agg', '') AS payload_digest,
    CASE WHEN page_id = newest THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id <> newest THEN newest END AS refers_to
FROM bits
"""
