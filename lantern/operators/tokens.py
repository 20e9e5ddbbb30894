"""Tokenising on Spark: a vocabulary built from the data, or a tokenizer the caller supplies."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lantern.functions.preference import cut
from lantern.functions.text import words
from lantern.operators.ranking import positions
from lantern.session import durable

Tokenizer = Callable[[list[str]], Sequence[Sequence[int]]]

# a vocabulary up to this size is held by every worker
VOCABULARY_BYTES = 64 << 20


def vocabulary(df: DataFrame, *texts: str) -> DataFrame:
    """Every word with its id: rank by count, then by the word itself.

    Words are counted per task before the shuffle, so a word that makes up a third of the text is one
    row per task; ids come from a distributed order, so the whole vocabulary never meets in one task.
    """
    every = F.explode(F.concat(*[words(t) for t in texts]))
    counted = df.select(every.alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return positions(counted, [F.col("n").desc(), F.col("word")], "id").select(
        "word", "n", F.col("id").cast("int").alias("id")
    )


def no_ids() -> Column:
    return F.array().cast("array<int>")


def with_tokenizer(df: DataFrame, text: Column, name: str, tokenizer: Tokenizer) -> DataFrame:
    """Token ids from a batch tokenizer: row-local, no shuffle."""

    @F.pandas_udf("array<int>")
    def encode(values: pd.Series) -> pd.Series:
        return pd.Series([list(ids) for ids in tokenizer(values.tolist())])

    return df.withColumn(name, encode(text))


def with_vocabulary(
    df: DataFrame,
    texts: dict[str, Column],
    vocab: DataFrame,
    max_length: int | None,
    keep: str = "start",
    broadcast_bytes: int = VOCABULARY_BYTES,
) -> DataFrame:
    """Token ids of several text columns against one vocabulary; words that it lacks get the id that
    follows its last one, so that no token is lost.

    A vocabulary of up to ``broadcast_bytes`` goes to every worker and the rows stay where they are: no
    shuffle, one Arrow pass over the words. A larger one is joined: rows are numbered and stored first,
    their words are looked up by a join (hot words split as a skewed join) and only ids come back.
    Rows may repeat, in all columns.
    """
    token_columns = {
        name: (words(text) if max_length is None else cut(words(text), max_length, keep))
        for name, text in texts.items()
    }
    seen = vocab.agg(F.count(F.lit(1)).alias("words"), F.sum(F.octet_length("word") + 80).alias("bytes")).first()
    unknown = seen.words
    if (seen.bytes or 0) <= broadcast_bytes:
        rows = vocab.select("word", "id").toLocalIterator()
        sent = df.sparkSession.sparkContext.broadcast({r.word: r.id for r in rows})

        @F.pandas_udf("array<int>")
        def encode(values: pd.Series) -> pd.Series:
            ids = sent.value
            return pd.Series([None if v is None else [ids.get(w, unknown) for w in v] for v in values])

        return df.withColumns({name: F.coalesce(encode(c), no_ids()) for name, c in token_columns.items()})
    held = durable(
        df.select(*df.columns, *[c.alias(f"_w_{n}") for n, c in token_columns.items()]).withColumn(
            "_row", F.monotonically_increasing_id()
        )
    )
    every = F.concat(*[F.coalesce(F.col(f"_w_{n}"), F.array().cast("array<string>")) for n in texts])
    wanted = held.select("_row", F.posexplode(every).alias("_at", "_word"))
    known_words = vocab.select(F.col("word").alias("_word"), F.col("id").alias("_id"))
    found = (
        wanted.join(known_words, "_word", "left")
        .select("_row", F.struct("_at", F.coalesce("_id", F.lit(unknown)).cast("int").alias("_id")).alias("_token"))
        .groupBy("_row")
        .agg(F.array_sort(F.collect_list("_token")).alias("_ids"))
    )
    coded = held.join(found, "_row", "left")
    start = F.lit(1)
    for n in texts:
        length = F.greatest(F.coalesce(F.size(F.col(f"_w_{n}")), F.lit(0)), F.lit(0))
        ids = F.transform(F.slice("_ids", start, length), lambda z: z["_id"])
        coded = coded.withColumn(n, F.coalesce(ids, no_ids()))
        start = start + length
    return coded.drop("_row", "_ids", *[f"_w_{n}" for n in texts])
