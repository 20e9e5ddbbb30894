"""Token streams (ST1-ST5): framing, reassembly per request and continuous scoring."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from lantern.functions.text import col
from lantern.operators.evaluate import evaluate

# How a line of the wire format begins, and the kinds of events.
LINE_PREFIX = "data: "
TOKEN, RESULT, DONE, ERROR = "token", "result", "done", "error"

EVENT = "request_id string, seq int, type string, content string, message string, ts timestamp"
RUN = (
    "request_id string, seqs array<int>, contents array<string>, closed string, message string, "
    "end_seq int, at_ms long"
)
RUN_COLUMNS = ["request_id", "seqs", "contents", "closed", "message", "end_seq", "at_ms"]
EXPIRY_MS = 3_600_000
EXPIRED = "expired"
FINISHED = "request_id string, status string, predicted_answer string, message string, n_tokens int"
STATE = (
    "text string, next_seq int, seqs array<int>, contents array<string>, closed string, "
    "message string, end_seq int, last_ms long"
)


def read_lines(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """A stream of text lines from a directory; a file appears in it whole, so no line is cut (ST4)."""
    reader = spark.readStream.format("text")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def parse_lines(lines: DataFrame, value: str = "value") -> DataFrame:
    """Events of lines that begin with the prefix; other lines are left out (ST4).

    ``corrupt`` holds a payload that could not be read, so that it can be sent elsewhere while the rest
    goes on (ST3).
    """
    payload = F.substring(F.col(value), len(LINE_PREFIX) + 1, 1 << 30)
    event = F.from_json(
        payload,
        f"{EVENT}, _corrupt_record string",
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"},
    )
    return (
        lines.where(F.startswith(F.col(value), F.lit(LINE_PREFIX)))
        .withColumn("_event", event)
        .select("_event.*")
        .withColumnRenamed("_corrupt_record", "corrupt")
    )


def wire_line(**fields: Column) -> Column:
    """One event as a line of the wire format (ST4)."""
    return F.concat(F.lit(LINE_PREFIX), F.to_json(F.struct(*[c.alias(n) for n, c in fields.items()])))


def token_runs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Events of a request that arrived together as one row, so that a long answer crosses the shuffle
    as a few runs of tokens and not token by token."""
    for batch in batches:
        if not len(batch):
            continue
        tokens = batch[batch.type == TOKEN]
        tokens = tokens.assign(content=tokens.content.fillna(""))
        runs = tokens.groupby("request_id", sort=False).agg(seqs=("seq", list), contents=("content", list))
        ends = batch[batch.type.isin([DONE, ERROR])].sort_values("seq").drop_duplicates("request_id")
        ends = ends.set_index("request_id")[["type", "message", "seq"]]
        ends.columns = ["closed", "message", "end_seq"]
        newest = batch.groupby("request_id", sort=False).agg(at_ms=("at_ms", "max"))
        whole = newest.join(runs).join(ends)
        for name in ("seqs", "contents"):
            whole[name] = [x if isinstance(x, list) else [] for x in whole[name]]
        whole["end_seq"] = whole["end_seq"].astype("Int32")
        whole["at_ms"] = whole["at_ms"].astype("Int64")
        yield whole.reset_index()[RUN_COLUMNS]


def collect_request(
    key: tuple[str], runs: Iterator[pd.DataFrame], state: GroupState, expiry_ms: int = EXPIRY_MS
) -> Iterator[pd.DataFrame]:
    """Tokens of one request until all up to its end are there; a repeated token counts once.

    The text up to the first gap is kept joined, so a long request does not stay a long list; only
    tokens beyond a gap are kept one by one. A request that expires gives a row too.
    """
    if state.hasTimedOut:
        _, next_seq, seqs, *_ = state.get
        state.remove()
        yield pd.DataFrame(
            {
                "request_id": [key[0]],
                "status": [EXPIRED],
                "predicted_answer": [None],
                "message": ["no closing event"],
                "n_tokens": [next_seq + len(seqs)],
            }
        )
        return
    text, next_seq, waiting = "", 0, {}
    closed = message = end_seq = None
    last_ms = 0
    if state.exists:
        text, next_seq, seqs, contents, closed, message, end_seq, last_ms = state.get
        waiting = dict(zip(seqs, contents))
    for part in runs:
        for row in part.itertuples():
            if not pd.isna(row.at_ms):
                last_ms = max(last_ms, int(row.at_ms))
            waiting.update((int(s), c) for s, c in zip(row.seqs, row.contents) if s >= next_seq)
            if isinstance(row.closed, str) and closed is None:
                closed, end_seq = row.closed, int(row.end_seq)
                message = row.message if isinstance(row.message, str) else None
    ready = []
    while next_seq in waiting and next_seq != end_seq:
        ready.append(waiting.pop(next_seq))
        next_seq += 1
    text += "".join(ready)
    if closed == ERROR or (closed == DONE and next_seq == end_seq):
        state.remove()
        yield pd.DataFrame(
            {
                "request_id": [key[0]],
                "status": [closed],
                "predicted_answer": [text if closed == DONE else None],
                "message": [message],
                "n_tokens": [next_seq + sum(s < end_seq for s in waiting)],
            }
        )
        return
    order = sorted(waiting)
    kept = [waiting[s] for s in order]
    state.update((text, next_seq, order, kept, closed, message, end_seq, last_ms))
    # counted from the newest event: before the first batch ends the watermark still stands at zero
    newest = max(last_ms, state.getCurrentWatermarkMs())
    if newest > 0:
        state.setTimeoutTimestamp(newest + expiry_ms)


def reassemble(events: DataFrame, lateness: str = "1 hour", expiry_ms: int = EXPIRY_MS) -> DataFrame:
    """One row per finished request: status done with the whole text, or error (ST1-ST3).

    ``seq`` counts the tokens of a request from 0 and its closing event takes the next number, so tokens
    may come in any order, twice, or after the closing event. A request that has not closed when the
    watermark is ``expiry_ms`` (an hour) past its newest event gets a row with status expired, and is
    forgotten.
    """
    # time crosses Python as a number: a timestamp would become local time there
    slim = events.select(
        "request_id", "seq", "type", "content", "message", F.unix_millis("ts").alias("at_ms")
    )
    runs = slim.mapInPandas(token_runs, RUN).withColumn("ts", F.timestamp_millis("at_ms"))
    return (
        runs.withWatermark("ts", lateness)
        .groupBy("request_id")
        .applyInPandasWithState(
            partial(collect_request, expiry_ms=expiry_ms), FINISHED, STATE, "append", GroupStateTimeout.EventTimeTimeout
        )
    )


def score_stream(
    finished: DataFrame,
    dataset: str = "dataset",
    gold: str = "gold_answer",
    choices: str | None = None,
    summaries: bool = True,
) -> DataFrame:
    """Finished predictions scored as they come (ST5): stateless, the batch scorer on a stream."""
    return evaluate(finished, dataset, "predicted_answer", gold, choices, summaries)


def result_lines(scored: DataFrame) -> DataFrame:
    """What is sent out for a finished request, in wire format: its result and then done, or one error
    (ST2, ST3). ``place`` orders the lines of a request. The result has whatever of the example and its
    score ``scored`` has, details included."""
    payload = ["dataset", "prompt", "predicted_answer", "gold_answer", "score", "metric", "details"]
    whole = [name for name in payload if name in scored.columns]
    result = wire_line(type=F.lit(RESULT), **{name: F.col(name) for name in whole})
    error = wire_line(type=F.lit(ERROR), message=F.col("message"))
    lines = F.when(F.col("status").isin(ERROR, EXPIRED), F.array(error)).otherwise(
        F.array(result, wire_line(type=F.lit(DONE)))
    )
    return scored.select("request_id", F.posexplode(lines).alias("place", "line"))


def run_available(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Everything there is now, written as parquet below ``path``. Started again on the same checkpoint
    it goes on where it stopped."""
    query = (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    if query.exception():
        raise query.exception()


def write_batch(part: DataFrame, path: str, batch: int) -> None:
    """A batch's rows in a folder of their own, which a repetition of the batch replaces: written twice or
    broken off, the table at ``path`` (with a column ``batch``) has them once."""
    part.write.mode("overwrite").parquet(f"{path}/batch={batch}")


def run_routed(events: DataFrame, path: str, letters: str, checkpoint: str, corrupt: str = "corrupt") -> None:
    """Everything there is now in two tables: events that could be read at ``path``, the rest, with the payload
    as it came, at ``letters`` (ST3).

    Both writes carry the number of the batch. After a failure between them the same batch comes again from the
    checkpoint, with the same lines, and replaces what it had written; lines are neither lost nor doubled.
    """

    def both(part: DataFrame, batch: int) -> None:
        part = part.persist()
        try:
            write_batch(part.where(F.col(corrupt).isNull()).drop(corrupt), path, batch)
            write_batch(part.where(F.col(corrupt).isNotNull()).select(corrupt), letters, batch)
        finally:
            part.unpersist()

    query = events.writeStream.foreachBatch(both).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    if query.exception():
        raise query.exception()


def text_tokens(text: Column | str) -> Column:
    """A text as the tokens that give it back when joined: runs of non-space with the space after."""
    return F.regexp_extract_all(col(text), F.lit(r"\S+\s*|^\s+"), F.lit(0))
