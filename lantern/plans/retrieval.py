"""Queries: chunks, vectors, neighbours, prompts and batch inference (R, I, S1)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lantern.functions.vectors import word_buckets
from lantern.operators import inference, retrieval
from lantern.plans.inputs import dealt, quoted, sql_draw, sql_strip, sql_words, table
from lantern.session import fresh_path
from lantern.sources.fixed_values import CHUNK_OVERLAP, CHUNK_SIZE, NO_INDEX, RETRIEVAL_SYSTEM
from lantern.sources.tables import read_text_documents

Frame = DataFrame
DIMENSIONS = 64
VECTOR = {"query_id": "vec_id", "index_id": "vec_id"}


def ingest_chunks(spark: SparkSession, sf_dir: str) -> Frame:
    """Every document in chunks of at most 1000 characters that overlap by up to 200."""
    return retrieval.chunk_documents(dealt(spark, sf_dir, "documents"), ["doc_id"])


# The chunk rule said with prefix sums. A line of 1000 characters or more, or a text without line breaks,
# is a run of words; lines between such lines are a run of lines. In a run, a chunk that begins at
# piece f ends at the last piece whose running length is at most 1000 more, and the next begins at the
# first piece that leaves at most 200 characters before, and room for, the piece that did not fit.
SQL_CHUNKS = f"""WITH RECURSIVE
    line AS (SELECT doc_id, i, CASE WHEN i = 1 THEN e ELSE chr(10) || e END AS piece, n = 1 AS alone FROM (
        SELECT doc_id, unnest(l) AS e, generate_subscripts(l, 1) AS i, len(l) AS n
        FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents))),
    sized AS (SELECT doc_id, i, piece, alone OR length(piece) >= {CHUNK_SIZE} AS big FROM line WHERE piece <> ''),
    run AS (SELECT doc_id, i, piece, big, sum(CASE WHEN big OR before THEN 1 ELSE 0 END)
            OVER (PARTITION BY doc_id ORDER BY i) AS run
        FROM (SELECT *, coalesce(lag(big) OVER (PARTITION BY doc_id ORDER BY i), false) AS before FROM sized)),
    word AS (SELECT doc_id, run, i, j, CASE WHEN j = 1 THEN w ELSE ' ' || w END AS piece FROM (
        SELECT doc_id, run, i, unnest(string_split(piece, ' ')) AS w,
            generate_subscripts(string_split(piece, ' '), 1) AS j FROM run WHERE big)),
    part AS MATERIALIZED (SELECT *, upto - length(piece) AS start FROM (
        SELECT doc_id, run, piece, row_number() OVER w AS p, CAST(sum(length(piece)) OVER w AS BIGINT) AS upto
        FROM (SELECT doc_id, run, i, 0 AS j, piece FROM run WHERE NOT big
            UNION ALL SELECT doc_id, run, i, j, piece FROM word WHERE piece <> '')
        WINDOW w AS (PARTITION BY doc_id, run ORDER BY i, j ROWS UNBOUNDED PRECEDING))),
    ends AS (SELECT a.doc_id, a.run, a.p AS f, b.p AS last FROM (SELECT *, start + {CHUNK_SIZE} AS most FROM part) a
        ASOF JOIN part b ON a.doc_id = b.doc_id AND a.run = b.run AND a.most >= b.upto),
    over AS (SELECT e.*, greatest(q.start - {CHUNK_OVERLAP}, q.upto - {CHUNK_SIZE}) AS least FROM ends e
        JOIN part q ON e.doc_id = q.doc_id AND e.run = q.run AND q.p = e.last + 1),
    jump AS MATERIALIZED (SELECT e.doc_id, e.run, e.f, e.last, b.p AS next FROM ends e
        LEFT JOIN over o ON e.doc_id = o.doc_id AND e.run = o.run AND e.f = o.f
        ASOF LEFT JOIN part b ON o.doc_id = b.doc_id AND o.run = b.run AND o.least <= b.start),
    chunk AS (SELECT doc_id, run, f, last, next FROM jump WHERE f = 1
        UNION ALL SELECT j.doc_id, j.run, j.f, j.last, j.next FROM chunk c
        JOIN jump j ON c.doc_id = j.doc_id AND c.run = j.run AND c.next = j.f)
    SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY run, f) - 1 AS INT) AS chunk_no, text
    FROM (SELECT c.doc_id, c.run, c.f, {sql_strip("string_agg(q.piece, '' ORDER BY q.p)")} AS text FROM chunk c
        JOIN part q ON c.doc_id = q.doc_id AND c.run = q.run AND q.p BETWEEN c.f AND c.last GROUP BY ALL)
    WHERE text <> ''"""


def text_documents(spark: SparkSession, sf_dir: str) -> Frame:
    """Passages written as one text file each and read back as documents."""
    path = fresh_path(spark, "texts")
    table(spark, sf_dir, "benchmark").write.partitionBy("item_id").text(path)
    read = read_text_documents(spark, f"{path}/item_id=*")
    # the writer ends each file with a line break
    return read.select(F.rtrim(F.col("text"), F.lit("\n")).alias("text"))


SQL_TEXTS = "SELECT rtrim(text, chr(10)) AS text FROM benchmark"


# --- neighbours ----------------------------------------------------------------------------------
def neighbours(spark: SparkSession, sf_dir: str, method: str) -> Frame:
    vectors = table(spark, sf_dir, "embeddings")
    return retrieval.top_k(vectors, dealt(spark, sf_dir, "embeddings"), 3, method, skip_self=True, **VECTOR)


def rounded(found: Frame) -> Frame:
    return found.withColumn("distance", F.round("distance", 6))


def knn_top3(spark: SparkSession, sf_dir: str) -> Frame:
    return rounded(neighbours(spark, sf_dir, "auto"))


def knn_blocks(spark: SparkSession, sf_dir: str) -> Frame:
    """The same neighbours by the way taken for more queries than fit every task."""
    return rounded(neighbours(spark, sf_dir, "blocks"))


def ann_top3(spark: SparkSession, sf_dir: str) -> Frame:
    """An index written in cells, opened, and searched in the nearest of them: per rank the number of
    queries and whether at least nine in ten found the very neighbour that an exact search finds."""
    path = fresh_path(spark, "cells")
    retrieval.write_cells(dealt(spark, sf_dir, "embeddings"), path, "vec_id")
    queries = dealt(spark, sf_dir, "embeddings")
    index = retrieval.open_cells(spark, path)
    # these vectors have no clusters: three in four cells are looked into for that recall
    probes = -(-3 * len(index.centres) // 4)
    found = retrieval.top_k(queries, index, 3, query_id="vec_id", skip_self=True, probes=probes)
    exact = retrieval.top_k(queries, queries, 3, query_id="vec_id", index_id="vec_id", skip_self=True)
    hits = found.select("query_id", "neighbour_id", F.lit(1).alias("hit"))
    met = exact.join(hits, ["query_id", "neighbour_id"], "left")
    return met.groupBy("rank").agg(
        F.count(F.lit(1)).alias("queries"), (F.avg(F.coalesce("hit", F.lit(0))) >= 0.9).alias("recall_reached")
    )


SQL_ANN = """SELECT unnest(range(1, 4))::INT AS rank, count(*) AS queries, true AS recall_reached FROM embeddings"""


def knn_cells(spark: SparkSession, sf_dir: str) -> Frame:
    """An index in cells, all of which are searched: the exact neighbours again."""
    path = fresh_path(spark, "cells")
    retrieval.write_cells(dealt(spark, sf_dir, "embeddings"), path, "vec_id", n_cells=12)
    queries = table(spark, sf_dir, "embeddings")
    found = retrieval.top_k(
        queries, retrieval.open_cells(spark, path), 3, query_id="vec_id", skip_self=True, probes=12
    )
    return rounded(found)


SQL_FOUND = f"""SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbour_id)
        AS INT) AS rank, neighbour_id, distance FROM (SELECT q.vec_id AS query_id, x.vec_id AS neighbour_id,
        power(array_distance(q.v, x.v), 2) AS distance
        FROM (SELECT vec_id, embedding::DOUBLE[{DIMENSIONS}] AS v FROM embeddings) q
        JOIN (SELECT vec_id, embedding::DOUBLE[{DIMENSIONS}] AS v FROM embeddings) x ON q.vec_id <> x.vec_id)
    QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbour_id) <= 3"""
SQL_KNN = f"SELECT query_id, rank, neighbour_id, round(distance, 6) AS distance FROM ({SQL_FOUND})"


def vector_texts(spark: SparkSession, sf_dir: str) -> Frame:
    """Text of a vector: the document with its number."""
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def knn_context(spark: SparkSession, sf_dir: str) -> Frame:
    found = neighbours(spark, sf_dir, "auto")
    return retrieval.contexts(found, vector_texts(spark, sf_dir), "doc_id")


SQL_CONTEXT = f"""SELECT query_id, coalesce(string_agg(text, chr(10) ORDER BY rank), '') AS context
    FROM ({SQL_FOUND}) f LEFT JOIN documents d ON f.neighbour_id = d.doc_id GROUP BY 1"""


def questions_by_vector(spark: SparkSession, sf_dir: str) -> Frame:
    """One question per vector: the benchmark passages in turn."""
    passages = table(spark, sf_dir, "benchmark").select("item_id", F.col("text").alias("question"))
    how_many = passages.agg(F.count(F.lit(1))).scalar()
    ids = table(spark, sf_dir, "embeddings").select("vec_id", (F.col("vec_id") % how_many).alias("item_id"))
    return ids.join(passages, "item_id").select(F.col("vec_id").alias("id"), "question")


def rag_prompt(spark: SparkSession, sf_dir: str) -> Frame:
    made = retrieval.question_prompts(knn_context(spark, sf_dir), questions_by_vector(spark, sf_dir))
    return made.select("query_id", "system_prompt", "prompt")


SQL_PROMPT = f"""SELECT c.query_id, {quoted(RETRIEVAL_SYSTEM)} AS system_prompt, 'Context: ' || c.context || ' '
    || chr(10) || chr(10) || ' Questions: ' || b.text AS prompt FROM ({SQL_CONTEXT}) c
    JOIN benchmark b ON c.query_id % (SELECT count(*) FROM benchmark) = b.item_id"""


# --- embedding and index -------------------------------------------------------------------------
def tfidf_embed(spark: SparkSession, sf_dir: str) -> Frame:
    docs = dealt(spark, sf_dir, "documents")
    weights = retrieval.fit_word_weights(docs, "text", DIMENSIONS, portable=True)
    embed = retrieval.hashed_embedder(weights, portable=True)
    vectors = docs.select("doc_id", embed(F.col("text")).alias("v"))
    return (
        # a plain explode would have Spark ask for the size first, and compute each vector twice
        vectors.select("doc_id", F.posexplode_outer("v").alias("bucket", "weight"))
        .where("weight <> 0")
        .withColumn("weight", F.round("weight", 6))
    )


SQL_TFIDF = f"""WITH tf AS MATERIALIZED (SELECT doc_id, CAST(CAST('0x' || substr(md5(word), 1, 8) AS BIGINT)
        % {DIMENSIONS} AS INT) AS bucket, count(*) AS n FROM (SELECT doc_id, unnest({sql_words('text')}) AS word
        FROM documents) GROUP BY ALL),
    idf AS (SELECT bucket, ln(((SELECT count(*) FROM documents) + 1)::DOUBLE / (count(*) + 1)) AS w FROM tf GROUP BY 1),
    v AS (SELECT doc_id, bucket, n * w AS x FROM tf JOIN idf USING (bucket))
    SELECT doc_id, bucket, round(x / sqrt(sum(x * x) OVER (PARTITION BY doc_id)), 6) AS weight FROM v WHERE x <> 0"""


def index_roundtrip(spark: SparkSession, sf_dir: str) -> Frame:
    """An index of the English texts, then all texts appended: each is in it once."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.lit(0).alias("chunk_no"), "lang", "text")
    weights = retrieval.fit_word_weights(docs, "text", DIMENSIONS)
    embed, path = retrieval.hashed_embedder(weights), fresh_path(spark, "index")
    retrieval.write_index(docs.where("lang = 'en'"), path, embed, ["doc_id", "chunk_no"])
    retrieval.write_index(docs, path, embed, ["doc_id", "chunk_no"], append=True)
    return retrieval.open_index(spark, path).select("doc_id", "text", F.size("embedding").alias("width"))


SQL_INDEX = f"SELECT doc_id, text, {DIMENSIONS} AS width FROM documents"


# --- inference -----------------------------------------------------------------------------------
# Stand-ins for a model: small, deterministic, and simple enough to say in SQL.
def load_measurer() -> inference.Predictor:
    def measure(prompts: list[str], seeds: list[int]) -> Sequence[str]:
        if any("ß" in p for p in prompts):
            raise RuntimeError("cannot read this letter")
        return [f" {len(p)} characters\n" for p in prompts]

    return measure


def load_picker() -> inference.Predictor:
    def pick(prompts: list[str], seeds: list[int]) -> Sequence[str]:
        split = [p.split(" ") for p in prompts]
        return [words[seed % len(words)] for words, seed in zip(split, seeds)]

    return pick


def load_counter() -> inference.Scorer:
    return lambda texts: [t.count("e") / max(len(t), 1) for t in texts]


def batch_answer(spark: SparkSession, sf_dir: str) -> Frame:
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", F.col("text").alias("prompt"), F.when(F.col("lang") == "en", F.lit("Answer.")).otherwise("").alias("system")
    )
    return inference.predict(docs, load_measurer, "prompt", "system").select(
        "doc_id", "predicted_answer", "error"
    )


SQL_ANSWER = """SELECT doc_id, CASE WHEN NOT contains(p, 'ß') THEN length(p) || ' characters' END AS predicted_answer,
    CASE WHEN contains(p, 'ß') THEN 'cannot read this letter' END AS error
    FROM (SELECT doc_id, CASE WHEN lang = 'en' THEN 'Answer.' || chr(10) || chr(10) ELSE '' END || text AS p
        FROM documents)"""


def sample_completions(spark: SparkSession, sf_dir: str) -> Frame:
    prompts = table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("prompt"))
    return inference.sample_completions(prompts, load_picker, 4, "doc_id").select(
        "doc_id", "sample_no", "completion"
    )


SQL_SAMPLES = f"""SELECT doc_id, sample_no, trim(words[CAST({sql_draw('doc_id', 'sample_no')} % len(words) + 1 AS BIGINT)],
        ' ' || chr(9) || chr(10) || chr(13)) AS completion
    FROM (SELECT doc_id, string_split(text, ' ') AS words, unnest(range(4))::INT AS sample_no FROM documents)"""


def reward_score(spark: SparkSession, sf_dir: str) -> Frame:
    talks = table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", F.col("role").alias("prompt"), F.col("text").alias("completion")
    )
    return inference.reward(talks, load_counter).select("conv_id", "turn", F.round("reward", 8).alias("reward"))


SQL_REWARD = """SELECT conv_id, turn, round((length(t) - length(replace(t, 'e', '')))::DOUBLE / greatest(length(t), 1), 8)
    AS reward FROM (SELECT conv_id, turn, role || text AS t FROM conversations)"""


ANSWER_DIMENSIONS = 256


def rag_answer(spark: SparkSession, sf_dir: str) -> Frame:
    """Documents chunked, embedded and indexed; every benchmark passage asked."""
    chunks = ingest_chunks(spark, sf_dir).withColumn(
        "id", F.col("doc_id") * 1_000_000 + F.col("chunk_no")
    )
    # cut and hashed once: the weights are fitted on the table that is then embedded
    kept, path = fresh_path(spark, "chunks"), fresh_path(spark, "index")
    chunks.withColumn("buckets", word_buckets("text", ANSWER_DIMENSIONS, portable=True)).write.parquet(kept)
    chunks = spark.read.parquet(kept)
    weights = retrieval.fit_bucket_weights(chunks, "buckets", ANSWER_DIMENSIONS)
    embed = retrieval.hashed_embedder(weights, portable=True)
    retrieval.write_index(chunks, path, retrieval.bucket_embedder(weights), ["doc_id", "chunk_no"], source="buckets")
    questions = table(spark, sf_dir, "benchmark").select("item_id", F.col("text").alias("question"))
    answered = retrieval.answer(
        questions, retrieval.open_index(spark, path), embed, load_measurer, question_id="item_id"
    )
    return answered.select("query_id", "question", "context", "answer", "error")


SQL_RAG_ANSWER = f"""WITH every AS MATERIALIZED (
        SELECT 'chunk' AS kind, doc_id * 1000000 + chunk_no AS id, text FROM ({SQL_CHUNKS})
        UNION ALL SELECT 'question', item_id, text FROM benchmark),
    tf AS MATERIALIZED (SELECT kind, id, CAST(CAST('0x' || substr(md5(word), 1, 8) AS BIGINT)
        % {ANSWER_DIMENSIONS} AS INT) AS bucket, count(*) AS n
        FROM (SELECT kind, id, unnest({sql_words('text')}) AS word FROM every) GROUP BY ALL),
    idf AS (SELECT b.bucket, ln(((SELECT count(*) FROM every WHERE kind = 'chunk') + 1)::DOUBLE
        / (count(tf.id) + 1)) AS w FROM (SELECT unnest(range({ANSWER_DIMENSIONS}))::INT AS bucket) b
        LEFT JOIN tf ON tf.bucket = b.bucket AND tf.kind = 'chunk' GROUP BY 1),
    weighted AS MATERIALIZED (SELECT kind, id, bucket, n * w AS x FROM tf JOIN idf USING (bucket)),
    norm AS (SELECT kind, id, sqrt(sum(x * x)) AS length FROM weighted GROUP BY ALL),
    vec AS MATERIALIZED (SELECT e.kind, e.id, list(CASE WHEN n.length > 0 THEN coalesce(CAST(CAST(x / n.length AS FLOAT)
            AS DOUBLE), 0) ELSE 0 END ORDER BY i.bucket)::DOUBLE[{ANSWER_DIMENSIONS}] AS v
        FROM every e CROSS JOIN idf i LEFT JOIN norm n ON e.kind = n.kind AND e.id = n.id
        LEFT JOIN weighted w ON e.kind = w.kind AND e.id = w.id AND i.bucket = w.bucket GROUP BY ALL),
    found AS (SELECT q.id AS query_id, x.id, row_number() OVER (PARTITION BY q.id
            ORDER BY array_distance(q.v, x.v), x.id) AS rank
        FROM vec q JOIN vec x ON q.kind = 'question' AND x.kind = 'chunk' QUALIFY rank <= 3),
    said AS (SELECT f.query_id, string_agg(e.text, chr(10) ORDER BY f.rank) AS context FROM found f
        JOIN every e ON e.kind = 'chunk' AND e.id = f.id GROUP BY 1),
    asked AS (SELECT query_id, text AS question, context, {quoted(RETRIEVAL_SYSTEM)} || chr(10) || chr(10)
        || 'Context: ' || context || ' ' || chr(10) || chr(10) || ' Questions: ' || text AS p
        FROM said JOIN benchmark ON query_id = item_id)
    SELECT query_id, question, context, CASE WHEN NOT contains(p, 'ß') THEN length(p) || ' characters' END
        AS answer, CASE WHEN contains(p, 'ß') THEN 'cannot read this letter' END AS error FROM asked"""


def index_refused(spark: SparkSession, sf_dir: str) -> Frame:
    """What opening an index says: one of the documents, one without rows, one that is not there."""
    there, empty, absent = (fresh_path(spark, "index") for _ in range(3))
    docs = table(spark, sf_dir, "documents").select("doc_id")
    docs.write.parquet(there)
    docs.where("doc_id < 0").write.parquet(empty)
    rows = []
    for name, path in (("there", there), ("empty", empty), ("absent", absent)):
        try:
            rows.append((name, retrieval.open_index(spark, path).count(), None))
        except ValueError as refusal:
            rows.append((name, None, str(refusal)))
    return spark.createDataFrame(rows, "name string, rows long, refusal string")


SQL_REFUSED = f"""SELECT 'there' AS name, count(*) AS rows, NULL AS refusal FROM documents
    UNION ALL SELECT unnest(['empty', 'absent']), NULL, {quoted(NO_INDEX)}"""

QUERIES = {
    "index_refused": (index_refused, SQL_REFUSED),
    "ingest_chunks": (ingest_chunks, SQL_CHUNKS),
    "text_documents": (text_documents, SQL_TEXTS),
    "knn_top3": (knn_top3, SQL_KNN),
    "knn_blocks": (knn_blocks, SQL_KNN),
    "knn_cells": (knn_cells, SQL_KNN),
    "ann_top3": (ann_top3, SQL_ANN),
    "knn_context": (knn_context, SQL_CONTEXT),
    "rag_prompt": (rag_prompt, SQL_PROMPT),
    "tfidf_embed": (tfidf_embed, SQL_TFIDF),
    "index_roundtrip": (index_roundtrip, SQL_INDEX),
    "batch_answer": (batch_answer, SQL_ANSWER),
    "sample_completions": (sample_completions, SQL_SAMPLES),
    "reward_score": (reward_score, SQL_REWARD),
    "rag_answer": (rag_answer, SQL_RAG_ANSWER),
}
