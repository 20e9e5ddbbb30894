"""Quality rules with a language-model verdict (operator 11).

Counts over a whole text give the plain rules. The verdict is a log-likelihood ratio: hashed runs of tokens,
counted over trusted texts and over all texts, make two multinomials; the mean logarithm of their ratio over
a document's tokens is its score, and one threshold decides for every document.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lantern.llm.texts import keyed, map_texts, slices
from lantern.session import durable

# The least words of a document, the share of repeated words in percent, the width of a window.
LEAST_WORDS = 20
MOST_REPEATED = 30
WINDOW = 8
SYMBOLS = b"#*$%&|<>"

# places for single tokens and as many again for pairs; the whole table is 8 MB in a task
BUCKETS = 1 << 20
# what is added to both counts of a bucket: pairs are rarer, and chance ones must not count
SMOOTH = (5.0, 400.0)
UNIT = 1000
# of the trusted documents that were not counted and pass the plain rules, so many percent may be rejected in
# each stratum (language); a stratum with fewer of them takes the threshold of all
LOSS = 1.5
LEAST_HELD = 100
SALT = 11
# trusted keys up to so many go to every task (a few dozen MB); more are joined
BROADCAST_KEYS = 1_000_000
BLOCK = 1 << 20

WHITE = b" \t\n\r\x0b\x0c"
TOKEN = re.compile(rb"[0-9a-z\x80-\xff]+|[^0-9a-z\x80-\xff\x09-\x0d ]+")
SPACE = re.compile(rb"[\x09-\x0d ]")


def blocks(data: bytes, size: int = BLOCK) -> Iterator[bytes]:
    """The bytes cut at white space into pieces of about ``size``; a stretch without any stays whole."""
    start = 0
    while start < len(data):
        space = SPACE.search(data, start + size)
        stop = space.start() if space else len(data)
        yield data[start:stop]
        start = stop


def features(data: bytes, buckets: int = BUCKETS, size: int = BLOCK) -> Iterator[tuple[int, list[int]]]:
    """For each block of a text: its number of tokens, and the buckets of its tokens and of the pairs that end in it."""
    crc32, last = zlib.crc32, None
    for block in blocks(data, size):
        tokens = TOKEN.findall(block.lower())
        singles = list(map(crc32, tokens))
        ahead = singles[:-1] if last is None else [last, *singles[:-1]]
        ended = tokens[1:] if last is None else tokens
        pairs = [crc32(token, crc32(b" ", before)) for token, before in zip(ended, ahead)]
        last = singles[-1] if singles else last
        yield len(tokens), [h % buckets for h in singles] + [buckets + h % buckets for h in pairs]


def repeated_words(words: list[bytes], width: int = WINDOW) -> int:
    """How many words lie in a window of ``width`` words that the text has twice or more, overlaps included."""
    import numpy as np

    count = len(words) - width + 1
    if count < 2:
        return 0
    each = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    windows = np.zeros(count, np.uint64)
    for i in range(width):
        windows = windows * np.uint64(0x9E3779B97F4A7C15) + (each[i : i + count] ^ (each[i : i + count] >> np.uint64(29)))
    order = np.argsort(windows, kind="stable")
    same = windows[order[1:]] == windows[order[:-1]]
    if not same.any():
        return 0
    steps = np.zeros(len(words) + 1, np.int64)
    starts = np.unique(np.concatenate([order[1:][same], order[:-1][same]]))
    steps[starts] += 1
    steps[starts + width] -= 1
    return int((np.cumsum(steps) > 0).sum())


def counts(text: str, data: bytes) -> tuple[int, int, int, int, int]:
    """``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines`` and ``n_repeat_words`` of a whole text."""
    words = data.split()
    lines = [line for line in data.split(b"\n") if line.strip()]
    white = len(data) - len(data.translate(None, WHITE))
    symbols = len(data) - len(data.translate(None, SYMBOLS))
    return len(words), len(text) - white, symbols, len(lines) - len(set(lines)), repeated_words(words)


def trusted_keys(labels: DataFrame) -> DataFrame:
    """``trusted``: the keys labelled good and not toxic, once each. A key that any row calls bad or toxic,
    or says nothing about, is left out."""
    good = (F.coalesce("quality", F.lit(0)) == 1) & (F.coalesce("toxic", F.lit(1)) == 0)
    rows = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min(good).alias("good"))
    return rows.where("good").select(F.col("doc_id").cast("bigint").alias("trusted"))


def counted(key: Column) -> Column:
    """Whether a trusted document's runs are counted: half of them by hash, the others set the threshold."""
    return F.conv(F.substring(F.sha2(F.concat(F.lit(f"{SALT}:"), key.cast("string")), 256), 1, 8), 16, 10).cast("bigint") % 2 == 0


@dataclass
class Ratio:
    """Per bucket the logarithm of the ratio of the multinomials, in whole thousandths."""

    weights: object
    buckets: int


def fit(docs: DataFrame, trusted: DataFrame, key: str = "doc_id", text: str = "text", buckets: int = BUCKETS) -> Ratio:
    """Both multinomials from every document: all of them, and the counted half of the trusted ones.

    Every task adds up its part in two arrays and sends a row per bucket at most. The raw counts are brought
    to the trusted total before ``SMOOTH`` is added, so a run that is as frequent here as there has 0. What
    comes to the driver is a number per bucket, at most 16 MB. Without trusted texts every weight is 0.
    """
    import numpy as np

    chosen = durable(trusted.where(counted(F.col("trusted"))))
    few = chosen.limit(BROADCAST_KEYS + 1).count() <= BROADCAST_KEYS
    rows = docs.select(F.col(f"`{key}`").cast("bigint").alias("key"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    rows = rows.join(F.broadcast(chosen) if few else chosen, F.col("key") == F.col("trusted"), "left")
    rows = rows.select(F.col("trusted").isNotNull().alias("good"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, 2 * buckets), np.int64)
        for batch in batches:
            for part in slices(batch, "text"):
                seen: tuple[list, list] = ([], [])
                for good, value in zip(part.column("good").to_pylist(), part.column("text").to_pylist()):
                    for _, found in features(value.encode(), buckets):
                        seen[good].append(np.array(found, np.int64))
                for side in (0, 1):
                    if seen[side]:
                        sums[side] += np.bincount(np.concatenate(seen[side]), minlength=2 * buckets)
        sums[0] += sums[1]
        used = np.flatnonzero(sums[0])
        arrays = [pa.array(used.astype(np.int32)), pa.array(sums[0][used]), pa.array(sums[1][used])]
        yield pa.RecordBatch.from_arrays(arrays, names=["bucket", "s", "t"])

    summed = rows.mapInArrow(run, "bucket int, s bigint, t bigint").groupBy("bucket").agg(F.sum("s").alias("s"), F.sum("t").alias("t"))
    summed = durable(summed)
    pair = F.col("bucket") >= buckets
    totals = {r.pair: r for r in summed.groupBy(pair.alias("pair")).agg(F.sum("s").alias("s"), F.sum("t").alias("t")).collect()}
    weights = np.zeros(2 * buckets, np.int32)
    for side in totals:
        share = F.col("s").cast("double") * F.lit(float(totals[side].t)) / F.lit(float(totals[side].s))
        smooth = F.lit(SMOOTH[side])
        weight = F.floor(F.lit(float(UNIT)) * F.log((F.col("t") + smooth) / (share + smooth))).cast("int")
        made = summed.where(pair == side).select("bucket", weight.alias("weight")).where("weight <> 0").toArrow()
        weights[made["bucket"].to_numpy()] = made["weight"].to_numpy()
    return Ratio(weights, buckets)


def profile(docs: DataFrame, ratio: Ratio, key: str = "doc_id", text: str = "text", stratum: str | None = None) -> DataFrame:
    """``key``, ``stratum`` (null if not asked for), the counts of the plain rules and ``score`` of every row,
    row by row.

    ``score`` is the sum of weights over the number of tokens, in whole ten-thousandths, floored; 0 without
    tokens. A null text is empty and has no words.
    """
    sent = docs.sparkSession.sparkContext.broadcast(ratio)
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "score")

    def rows() -> Callable:
        import numpy as np

        weights, buckets = sent.value.weights, sent.value.buckets

        def work(value: str) -> tuple:
            data, tokens, total = value.encode(), 0, 0
            for count, found in features(data, buckets):
                tokens += count
                total += int(weights[np.array(found, np.int64)].sum(dtype=np.int64))
            return *counts(value, data), 10 * total // tokens if tokens else 0

        return work

    group = F.col(f"`{stratum}`").cast("string") if stratum else F.lit(None).cast("string")
    both = F.struct(F.col(f"`{key}`").cast("bigint").alias("key"), group.alias("stratum"))
    made = docs.select(both.alias("key"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    arrow = pa.schema([("key", pa.struct([("key", pa.int64()), ("stratum", pa.string())])), *((name, pa.int64()) for name in names)])
    found = map_texts(made, rows, "key struct<key bigint, stratum string>, " + ", ".join(f"{n} bigint" for n in names), arrow)
    return found.select(F.col("key.key").alias(key), "key.stratum", *names)


def thresholds(profiled: DataFrame, trusted: DataFrame, loss: float = LOSS, key: str = "doc_id") -> DataFrame:
    """``group`` and ``least``: the least score that passes in each stratum, that below which ``loss`` percent
    of its trusted documents lie that were not counted and have not failed; strata with fewer than
    ``LEAST_HELD`` of those are not in it.

    From a count per stratum and score (scores are whole numbers in a fixed range), so a stratum of any size
    is few rows.
    """
    per_score = held_scores(profiled, trusted, key).groupBy("stratum", "score").agg(F.count(F.lit(1)).alias("n"))
    whole = Window.partitionBy("stratum")
    added = per_score.select(
        "stratum", "score", F.sum("n").over(whole).alias("all"), F.sum("n").over(whole.orderBy("score")).alias("ahead")
    )
    passing = added.where((F.col("all") >= LEAST_HELD) & (F.col("ahead") > F.floor(F.lit(loss) * F.col("all") / 100)))
    return passing.groupBy(F.col("stratum").alias("group")).agg(F.min("score").alias("least"))


def held_scores(profiled: DataFrame, trusted: DataFrame, key: str) -> DataFrame:
    held = trusted.where(~counted(F.col("trusted")))
    rows = profiled.where("NOT base_failed").select(F.col(key).alias("key"), "stratum", "score")
    return rows.join(held, F.col("key") == F.col("trusted"), "left_semi")


def overall(profiled: DataFrame, trusted: DataFrame, loss: float = LOSS, key: str = "doc_id") -> int:
    """The threshold of all strata together; 0 without trusted documents to find it from."""
    counts = held_scores(profiled, trusted, key).groupBy("score").agg(F.count(F.lit(1)).alias("n")).collect()
    lost, ahead = int(loss * sum(r.n for r in counts) / 100), 0
    for row in sorted(counts):
        ahead += row.n
        if ahead > lost:
            return row.score
    return 0


def judge(
    docs: DataFrame, labels: DataFrame, loss: float = LOSS, key: str = "doc_id", text: str = "text", stratum: str | None = None
) -> DataFrame:
    """Every row's ``key``, ``stratum``, the counts of the plain rules, ``base_failed``, ``score``, ``kept``.

    ``base_failed``: under 20 words, or over 30 % of the words in repeated windows. ``kept``: not failed, and
    the score reaches the threshold (of the row's ``stratum``, a column such as the language, if there is one;
    null is a stratum like any other). Null and empty texts have no words and fail. Rows without a key are
    judged like any other; repeated rows are judged each by itself and count each; extra columns are left
    out; an empty table gives an empty table. Very long texts are split into words and lines as a whole (some
    times their size in memory), their runs in blocks.
    """
    trusted = trusted_keys(labels)
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    profiled = durable(profile(docs, fit(docs, trusted, key, text), key, text, stratum).withColumn("base_failed", failed))
    own = thresholds(profiled, trusted, loss, key)
    met = profiled.join(own, F.col("stratum").eqNullSafe(F.col("group")), "left")
    least = F.coalesce("least", F.lit(overall(profiled, trusted, loss, key)))
    return met.withColumn("kept", ~F.col("base_failed") & (F.col("score") >= least)).drop("group", "least")


def op11_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, score and verdict of every document."""
    docs, labels = (spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in ("documents", "labels"))
    return judge(docs, labels, stratum="lang").withColumnRenamed("stratum", "lang")


_STEPS = (
    "list_transform(range(256), lambda i: list_reduce(list_concat([i::UBIGINT], range(8)::UBIGINT[]), "
    "lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END))"
)
_LOW = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_HALF = "('0x' || substr(sha256('11:' || doc_id), 1, 8))::BIGINT % 2"
# checksums byte by byte, windows and lines as rows
OP11_SQL = f"""
WITH crc_table AS MATERIALIZED (SELECT {_STEPS} AS steps),
texts AS MATERIALIZED (SELECT doc_id, lang, coalesce(text, '') AS text FROM documents),
trusted AS (
    SELECT doc_id, {_HALF} = 0 AS counted FROM labels GROUP BY doc_id
    HAVING bool_and(coalesce(quality, 0) = 1) AND bool_and(coalesce(toxic, 1) = 0)
), split AS MATERIALIZED (
    SELECT doc_id, lang, text, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS w, regexp_extract_all({_LOW},
        '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+|[^0-9a-z\\x{{80}}-\\x{{10FFFF}}\\x09-\\x0D ]+') AS tokens FROM texts
), runs AS MATERIALIZED (
    SELECT doc_id, false AS pair, unnest(tokens) AS run FROM split UNION ALL
    SELECT doc_id, true, unnest(list_transform(range(1, len(tokens)), lambda i: tokens[i] || ' ' || tokens[i + 1])) FROM split
), hashed AS MATERIALIZED (
    SELECT run, xor(list_reduce(
        list_concat([4294967295::UBIGINT], list_transform(range(octet_length(encode(run))), lambda i:
            ('0x' || substr(hex(encode(run)), 2 * i + 1, 2))::UBIGINT)),
        lambda c, b: xor(steps[(xor(c, b) & 255)::BIGINT + 1], c >> 8)), 4294967295::UBIGINT) % 1048576 AS bucket
    FROM (SELECT DISTINCT run FROM runs), crc_table
), featured AS MATERIALIZED (
    SELECT doc_id, pair, bucket, count(*) AS n FROM runs JOIN hashed USING (run) GROUP BY ALL
), counted AS MATERIALIZED (
    SELECT pair, bucket, sum(n)::DOUBLE AS s, coalesce(sum(n) FILTER (counted), 0)::DOUBLE AS t
    FROM featured LEFT JOIN trusted USING (doc_id) GROUP BY ALL
), totals AS (
    SELECT pair, sum(s) AS all_s, sum(t) AS all_t, CASE WHEN pair THEN 400::DOUBLE ELSE 5::DOUBLE END AS k FROM counted GROUP BY pair
), weights AS (
    SELECT pair, bucket, floor(1000::DOUBLE * ln((t + k) / (s * all_t / all_s + k)))::BIGINT AS weight FROM counted JOIN totals USING (pair)
), scores AS (
    SELECT doc_id, floor(10 * sum(n * weight)::DOUBLE / sum(n) FILTER (NOT pair)::DOUBLE)::BIGINT AS score
    FROM featured JOIN weights USING (pair, bucket) GROUP BY doc_id
), covered AS (
    SELECT doc_id, count(DISTINCT place) AS n_repeat_words FROM (
        SELECT doc_id, unnest(range(first, first + 8)) AS place FROM (
            SELECT doc_id, first, count(*) OVER (PARTITION BY doc_id, shown) AS times FROM (
                SELECT doc_id, first, array_to_string(w[first:first + 7], ' ') AS shown
                FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS first FROM split)
            )
        ) WHERE times > 1
    ) GROUP BY doc_id
), lines AS (
    SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines
    FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM split)
    WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY doc_id
), based AS (
    SELECT doc_id, lang, len(w)::BIGINT AS n_words, len(array_to_string(w, ''))::BIGINT AS word_chars,
        len(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
        coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
        coalesce(score, 0) AS score, len(w) < 20 OR 100 * coalesce(n_repeat_words, 0) > 30 * len(w) AS base_failed
    FROM split LEFT JOIN covered USING (doc_id) LEFT JOIN lines USING (doc_id) LEFT JOIN scores USING (doc_id)
), held AS (
    SELECT lang, score, row_number() OVER (ORDER BY score) AS place, count(*) OVER () AS n,
        row_number() OVER (PARTITION BY lang ORDER BY score) AS own_place, count(*) OVER (PARTITION BY lang) AS own_n
    FROM based JOIN trusted USING (doc_id) WHERE NOT counted AND NOT base_failed
), own AS (
    SELECT lang AS own_lang, score AS own_least FROM held WHERE own_n >= 100 AND own_place = floor(1.5::DOUBLE * own_n / 100) + 1
), least AS (
    SELECT coalesce(min(score), 0) AS least FROM held WHERE place = floor(1.5::DOUBLE * n / 100) + 1
)
SELECT based.*, NOT base_failed AND score >= coalesce(own_least, least) AS kept
FROM based LEFT JOIN own ON lang IS NOT DISTINCT FROM own_lang, least
"""
