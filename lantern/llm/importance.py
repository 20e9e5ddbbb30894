"""Importance resampling towards a target distribution (operator 12).

Texts are bags of hashed runs of words (``prefixcrc``). The logarithm of how much likelier a bucket is among
the target texts than among all documents is its gain; a document's mean gain is its weight, and Gumbel noise
from its key makes the highest scores a sample without replacement in proportion to the weights.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import floor, log

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lantern.llm import prefixcrc
from lantern.llm.texts import keyed, map_texts, slices
from lantern.session import durable

BUCKETS = 10_000
WIDTH = 2
LEAST_WORDS = 20
PERCENT = 25
SEED = 7
# gains and noise are whole thousandths, so sums are exact in any order
UNIT = 1000


def bucket_counts(df: DataFrame, text: str, buckets: int = BUCKETS, width: int = WIDTH) -> DataFrame:
    """``bucket`` and ``n``: how many runs of words of all texts fall into each bucket that any falls into.

    Every task counts into one array and sends a row per bucket at most. Null and empty texts have no runs.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        counts = np.zeros(buckets, np.int64)
        for batch in batches:
            for part in slices(batch, "text"):
                for value in part.column("text").to_pylist():
                    for _, found in prefixcrc.checksums(value.encode(), width):
                        counts += np.bincount(found % np.uint32(buckets), minlength=buckets)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used])], names=["bucket", "n"])

    texts = df.select(F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    return texts.mapInArrow(run, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))


@dataclass
class Gains:
    """Per bucket the logarithm of the ratio of its shares, in whole thousandths."""

    values: object
    width: int


def fit(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS, width: int = WIDTH, text: str = "text") -> Gains:
    """Gains of ``target`` over ``docs``, both counted whole, with one added to every bucket.

    Two counts per bucket come to the driver, whatever the sizes of the tables. Empty tables are counted as
    such: then the added ones alone make the shares.
    """
    import numpy as np

    both = bucket_counts(docs, text, buckets, width).select("bucket", "n", F.lit(0).alias("side"))
    both = both.union(bucket_counts(target, text, buckets, width).select("bucket", "n", F.lit(1)))
    counts = [[0] * buckets, [0] * buckets]
    for row in both.collect():
        counts[row.side][row.bucket] = row.n
    (s, t), (all_s, all_t) = counts, map(sum, counts)
    gains = [
        floor(UNIT * log((float(t[b] + 1) * float(all_s + buckets)) / (float(s[b] + 1) * float(all_t + buckets))))
        for b in range(buckets)
    ]
    return Gains(np.array(gains, np.int64), width)


def weigh(docs: DataFrame, gains: Gains, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``n_words``, ``n_features`` and ``weight`` (the floored mean gain) of every row.

    Null, empty and wordless texts have no features and the weight 0. Repeated rows are weighed each by
    itself; extra columns are left out; an empty table gives an empty table. Of a text only about a megabyte
    of words is held as objects.
    """
    sent = docs.sparkSession.sparkContext.broadcast(gains)
    arrow = pa.schema([(n, pa.int64()) for n in ("key", "n_words", "n_features", "weight")])

    def rows():
        import numpy as np

        values, width = sent.value.values, sent.value.width
        buckets = np.uint32(len(values))

        def work(value: str) -> tuple:
            words = features = total = 0
            for count, found in prefixcrc.checksums(value.encode(), width):
                words += count
                features += len(found)
                total += int(values[found % buckets].sum())
            return words, features, total // features if features else 0

        return work

    made = keyed(docs, key, text).withColumn("key", F.col("key").cast("bigint"))
    schema = "key bigint, n_words bigint, n_features bigint, weight bigint"
    return map_texts(made, rows, schema, arrow).withColumnRenamed("key", key)


def noise(key: Column, seed: int = SEED) -> Column:
    """Gumbel noise of a key in whole thousandths: the same wherever and whenever it is drawn."""
    drawn = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), key.cast("string")), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-float(UNIT)) * F.log(-F.log((drawn + F.lit(0.5)) / F.lit(4294967296.0))))


def draw(
    weighed: DataFrame, percent: int = PERCENT, seed: int = SEED, least_words: int = LEAST_WORDS, key: str = "doc_id"
) -> DataFrame:
    """``weighed`` (see :func:`weigh`) with ``score`` and ``rank``: 1, 2, 3... down the drawn documents, which
    are ``percent`` of those with ``least_words`` words; null for the others.

    Scores are whole numbers in a range that does not grow with the table, and noise spreads even equal
    texts over thousands of them. So a count per score gives each score its first rank, and ranks within one
    score are found by a window over that score alone: no task sees more than some thousandth of the rows.
    Equal scores rank by key, then by features and weight. Rows without a key have no noise: their score is
    null, and they neither count nor are drawn. Repeated rows count and rank each.
    """
    scored = durable(weighed.withColumn("score", F.col("weight") + noise(F.col(key), seed)))
    able = F.col("score").isNotNull() & (F.col("n_words") >= least_words)
    per_score = {r.score: r.n for r in scored.where(able).groupBy("score").agg(F.count(F.lit(1)).alias("n")).collect()}
    wanted = percent * sum(per_score.values()) // 100
    ahead, starts = 0, []
    for score in sorted(per_score, reverse=True):
        if ahead >= wanted:
            break
        starts.append((score, ahead))
        ahead += per_score[score]
    spark = weighed.sparkSession
    starts_of = spark.createDataFrame(starts, "started bigint, ahead bigint")
    # a row per distinct score: at most some tens of thousands
    met = scored.join(F.broadcast(starts_of), able & (F.col("score") == F.col("started")), "left")
    within = Window.partitionBy("score", "ahead").orderBy(key, "n_features", "weight")
    drawn = met.where("ahead IS NOT NULL").withColumn("rank", F.col("ahead") + F.row_number().over(within))
    drawn = drawn.withColumn("rank", F.when(F.col("rank") <= wanted, F.col("rank")))
    rest = met.where("ahead IS NULL").withColumn("rank", F.lit(None).cast("bigint"))
    return drawn.unionByName(rest).drop("started", "ahead")


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``n_words``, ``n_features``, ``weight``, ``score`` and ``rank`` of every row of ``docs``, drawn
    towards the texts of ``target``. See :func:`weigh` and :func:`draw` for odd rows."""
    return draw(weigh(docs, fit(docs, target, text=text), key, text), percent, key=key)


def op12_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quarter of the documents drawn towards the benchmark's texts."""
    docs, target = (spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in ("documents", "benchmark"))
    return resample(docs, target).select("doc_id", "n_features", "weight", "score", "rank")


_TABLE = (
    "list_transform(range(256), lambda i: list_reduce(list_concat([i::UBIGINT], range(8)::UBIGINT[]), "
    "lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END))"
)
# the checksum byte by byte; the logarithms are the same functions of the same doubles
OP12_SQL = f"""
WITH crc_table AS MATERIALIZED (SELECT {_TABLE} AS steps),
texts AS (
    SELECT 0 AS side, doc_id AS id, text FROM documents UNION ALL SELECT 1, item_id, text FROM benchmark
), words AS MATERIALIZED (
    SELECT side, id, regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+'
    ) AS w FROM texts
), runs AS MATERIALIZED (
    SELECT side, id, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS run FROM words
), hashed AS MATERIALIZED (
    SELECT run, xor(list_reduce(
        list_concat([4294967295::UBIGINT], list_transform(range(octet_length(encode(run))), lambda i:
            ('0x' || substr(hex(encode(run)), 2 * i + 1, 2))::UBIGINT)),
        lambda c, b: xor(steps[(xor(c, b) & 255)::BIGINT + 1], c >> 8)), 4294967295::UBIGINT) % 10000 AS bucket
    FROM (SELECT DISTINCT run FROM runs), crc_table
), featured AS MATERIALIZED (
    SELECT side, id, bucket, count(*) AS n FROM runs JOIN hashed USING (run) GROUP BY ALL
), counted AS (
    SELECT bucket, coalesce(sum(n) FILTER (side = 0), 0)::DOUBLE AS s, coalesce(sum(n) FILTER (side = 1), 0)::DOUBLE AS t FROM featured GROUP BY bucket
), totals AS (
    SELECT coalesce(sum(s), 0) AS all_s, coalesce(sum(t), 0) AS all_t FROM counted
), gains AS (
    SELECT bucket, floor(1000 * ln(((t + 1) * (all_s + 10000)) / ((s + 1) * (all_t + 10000))))::BIGINT AS gain FROM counted, totals
), weighed AS (
    SELECT d.doc_id, len(w) AS n_words, coalesce(f.n, 0) AS n_features, coalesce(f.weight, 0) AS weight
    FROM documents d JOIN words ON side = 0 AND id = d.doc_id
    LEFT JOIN (
        SELECT id, sum(n)::BIGINT AS n, floor(sum(n * gain)::DOUBLE / sum(n)::DOUBLE)::BIGINT AS weight
        FROM featured JOIN gains USING (bucket) WHERE side = 0 GROUP BY id
    ) f ON f.id = d.doc_id
), scored AS (
    SELECT *, weight + floor(-1000 * ln(-ln((('0x' || substr(sha256('7:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
    FROM weighed
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id) AS place,
        25 * count(*) FILTER (n_words >= 20) OVER () // 100 AS wanted FROM scored
)
SELECT doc_id, n_features::BIGINT AS n_features, weight, score,
    CASE WHEN n_words >= 20 AND place <= wanted THEN place END::BIGINT AS rank FROM placed
"""
