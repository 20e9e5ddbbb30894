"""Queries: token streams replayed from the tables with everything that is there (ST)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lantern.plans.inputs import sql_letter, sql_strip, table
from lantern.session import fresh_path
from lantern.streaming import tokens

Frame = DataFrame
# by a hash of its id one request in sixteen fails, and another never ends
FAILS, HANGS = "3", "7"


def streamed(spark: SparkSession, sf_dir: str, name: str) -> Frame:
    """One table of the folder as a stream, be it one file or a folder of files."""
    schema = table(spark, sf_dir, name).schema
    # a stream takes a single file only as what a pattern finds
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/{name}.parque[t]")


def token_events(talks: Frame) -> Frame:
    """Assistant texts as token events and one closing event each, row by row."""
    replies = talks.where("role = 'assistant'").select(
        F.concat_ws("-", "conv_id", "turn").alias("request_id"),
        "turn",
        tokens.text_tokens("text").alias("_tokens"),
    )
    draw = F.substring(F.md5("request_id"), 1, 1)
    fails = draw == FAILS

    def event(kind, content, message):
        return F.struct(kind.alias("type"), content.alias("content"), message.alias("message"))

    nothing = F.lit(None).cast("string")
    parts = F.transform("_tokens", lambda t: event(F.lit(tokens.TOKEN), t, nothing))
    closing = F.array(
        event(
            F.when(fails, tokens.ERROR).otherwise(tokens.DONE),
            nothing,
            F.when(fails, "model failed"),
        )
    )
    closed = F.when(draw == HANGS, F.filter(closing, lambda c: F.lit(False))).otherwise(closing)
    start = F.lit("2024-01-01").cast("timestamp")
    return (
        replies.withColumn("_events", F.concat(parts, closed))
        .select("request_id", F.posexplode_outer("_events").alias("seq", "_event"))
        .where("seq is not null")
        .select(
            "request_id",
            "seq",
            "_event.*",
            F.timestamp_seconds(F.unix_timestamp(start) + F.col("seq")).alias("ts"),
        )
    )


def finished(spark: SparkSession, sf_dir: str) -> Frame:
    """Reassembled requests, as files."""
    out = fresh_path(spark, "finished")
    events = token_events(streamed(spark, sf_dir, "conversations"))
    tokens.run_available(tokens.reassemble(events), out, fresh_path(spark, "checkpoint"))
    return spark.read.schema(tokens.FINISHED).parquet(out)


def stream_reassemble(spark: SparkSession, sf_dir: str) -> Frame:
    return finished(spark, sf_dir)


TOKEN_SQL = r"len(regexp_extract_all(text, '\S+\s*|^\s+'))"
SQL_DRAW = "md5(conv_id || '-' || turn)[1]"
SQL_FINISHED = f"""SELECT conv_id || '-' || turn AS request_id, CASE WHEN {SQL_DRAW} = '{FAILS}' THEN 'error'
        ELSE 'done' END AS status, CASE WHEN {SQL_DRAW} <> '{FAILS}' THEN text END AS predicted_answer,
        CASE WHEN {SQL_DRAW} = '{FAILS}' THEN 'model failed' END AS message, CAST({TOKEN_SQL} AS INT) AS n_tokens
    FROM conversations WHERE role = 'assistant' AND {SQL_DRAW} <> '{HANGS}'"""


def scored_stream(spark: SparkSession, sf_dir: str) -> Frame:
    """Finished requests as a second stream, scored as they come against the talks' own texts."""
    source = fresh_path(spark, "finished")
    events = token_events(streamed(spark, sf_dir, "conversations"))
    tokens.run_available(tokens.reassemble(events), source, fresh_path(spark, "checkpoint"))
    gold = table(spark, sf_dir, "conversations").select(
        F.concat_ws("-", "conv_id", "turn").alias("request_id"),
        F.when(F.col("conv_id") % 2 == 0, "mmlu").otherwise("own").alias("dataset"),
        F.when(F.col("conv_id") % 2 == 0, "a ").otherwise(F.col("text")).alias("gold_answer"),
    )
    arriving = spark.readStream.schema(tokens.FINISHED).parquet(source)
    return tokens.score_stream(arriving.join(gold, "request_id"))


def stream_score(spark: SparkSession, sf_dir: str) -> Frame:
    """Scores of finished requests (ST5)."""
    out = fresh_path(spark, "scored")
    scored = scored_stream(spark, sf_dir).where("status = 'done'").select(
        "request_id", "dataset", "metric", "score"
    )
    tokens.run_available(scored, out, fresh_path(spark, "checkpoint"))
    return spark.read.schema("request_id string, dataset string, metric string, score double").parquet(out)


SQL_STREAM_SCORE = f"""SELECT request_id, CASE WHEN even THEN 'mmlu' ELSE 'own' END AS dataset,
    CASE WHEN even THEN 'accuracy' ELSE 'exact_match' END AS metric,
    CASE WHEN NOT even OR {sql_letter('predicted_answer')} = upper({sql_strip("'a '")}) THEN 1.0::DOUBLE
        ELSE 0.0::DOUBLE END AS score
    FROM (SELECT *, CAST(string_split(request_id, '-')[1] AS BIGINT) % 2 = 0 AS even FROM ({SQL_FINISHED}))
    WHERE status = 'done'"""


def stream_results(spark: SparkSession, sf_dir: str) -> Frame:
    """The lines sent out at the end of each request: result and done, or error (ST2, ST3)."""
    out = fresh_path(spark, "lines")
    details = F.struct(F.col("details.exact.method").alias("method"), F.col("details.choice.extracted_answer").alias("letter"))
    scored = scored_stream(spark, sf_dir).withColumns({"prompt": F.col("request_id"), "details": details})
    lines = tokens.result_lines(scored)
    tokens.run_available(lines, out, fresh_path(spark, "checkpoint"))
    return spark.read.schema("request_id string, place int, line string").parquet(out)


SQL_RESULTS = f"""SELECT f.request_id, CAST(0 AS INT) AS place, CASE f.status WHEN 'error'
        THEN 'data: {{"type":"error","message":"model failed"}}'
        ELSE 'data: {{"type":"result","dataset":"' || s.dataset || '","prompt":"' || f.request_id || '","predicted_answer":' ||
            CAST(to_json(f.predicted_answer) AS VARCHAR) || ',"gold_answer":' ||
            CAST(to_json(CASE s.dataset WHEN 'mmlu' THEN 'a ' ELSE f.predicted_answer END) AS VARCHAR) || ',"score":' || CASE s.score WHEN 1 THEN '1.0' ELSE '0.0' END
            || ',"metric":"' || s.metric || '","details":{{' || CASE s.dataset WHEN 'own' THEN '"method":"exact_match"'
            ELSE '"letter":"' || {sql_letter('f.predicted_answer')} || '"' END || '}}}}' END AS line
    FROM ({SQL_FINISHED}) f LEFT JOIN ({SQL_STREAM_SCORE}) s ON f.request_id = s.request_id
    UNION ALL SELECT request_id, 1, 'data: {{"type":"done"}}' FROM ({SQL_FINISHED}) WHERE status = 'done'"""


def wire_source(spark: SparkSession, sf_dir: str) -> str:
    """A folder of the talks in wire format among comments and broken payloads."""
    source = fresh_path(spark, "wire")
    talks = table(spark, sf_dir, "conversations")
    good = tokens.wire_line(
        request_id=F.col("conv_id").cast("string"),
        seq=F.col("turn").cast("int"),
        type=F.lit(tokens.TOKEN),
        content=F.col("text"),
    )
    line = F.when(F.col("role") == "system", F.concat(F.lit(": "), F.md5("text"))).otherwise(good)
    broken = F.concat(F.lit('data: {"request_id": "'), F.col("conv_id").cast("string"), F.lit('", "seq": '))
    lines = talks.select(line.alias("value")).unionByName(
        talks.where("role = 'system'").select(broken.alias("value"))
    )
    lines.write.text(source)
    return source


def stream_frames(spark: SparkSession, sf_dir: str) -> Frame:
    """Texts in wire format among comments and broken payloads: events read, the rest set aside."""
    out = fresh_path(spark, "events")
    events = tokens.parse_lines(tokens.read_lines(spark, wire_source(spark, sf_dir)))
    tokens.run_available(events, out, fresh_path(spark, "checkpoint"))
    read = spark.read.schema(f"{tokens.EVENT}, corrupt string").parquet(out)
    return read.select("request_id", "seq", "type", "content", "corrupt")


def stream_dead_letters(spark: SparkSession, sf_dir: str) -> Frame:
    """The same lines in several batches, routed to a table of events and one of dead letters (ST3)."""
    out, letters = fresh_path(spark, "events"), fresh_path(spark, "letters")
    lines = tokens.read_lines(spark, wire_source(spark, sf_dir), files_per_trigger=4)
    tokens.run_routed(tokens.parse_lines(lines), out, letters, fresh_path(spark, "checkpoint"))
    read = spark.read.schema(f"{tokens.EVENT}, batch long").parquet(out)
    dead = spark.read.schema("corrupt string, batch long").parquet(letters)
    return read.select("request_id", "seq", "type", "content").unionByName(dead.select("corrupt"), allowMissingColumns=True)


SQL_FRAMES = """SELECT CAST(conv_id AS VARCHAR) AS request_id, CAST(turn AS INT) AS seq, 'token' AS type,
    text AS content, NULL AS corrupt FROM conversations WHERE role <> 'system' UNION ALL
    SELECT NULL, NULL, NULL, NULL, '{"request_id": "' || conv_id || '", "seq": ' FROM conversations
    WHERE role = 'system'"""

QUERIES = {
    "stream_reassemble": (stream_reassemble, SQL_FINISHED),
    "stream_score": (stream_score, SQL_STREAM_SCORE),
    "stream_results": (stream_results, SQL_RESULTS),
    "stream_frames": (stream_frames, SQL_FRAMES),
    "stream_dead_letters": (stream_dead_letters, SQL_FRAMES),
}
