"""A training corpus from raw documents: five stages, each written as Parquet and read again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lantern.llm import bpe, decontaminate, nearcopies, pii, quality
from lantern.session import fresh_path, ship

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def filter_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on this input, accepts."""
    labels = ship(spark).read.parquet(f"{sf_dir}/labels.parquet")
    return quality.accepted(docs, quality.fit(spark, docs, labels))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near copies the document with the smallest id: candidates by the fingerprints of
    operator 3 and by MinHash beyond its bits, compared exactly (five-word Jaccard of 0.8 or more)."""
    ship(spark)
    return nearcopies.keep_one(docs)


def drop_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, nor one with other values in it."""
    return decontaminate.clean(docs, ship(spark).read.parquet(f"{sf_dir}/benchmark.parquet"))


def pseudonymise(spark: SparkSession, docs: DataFrame, sf_dir: str, key: str = "a key of one's own") -> DataFrame:
    """Personal data replaced by pseudonyms, and the lengths of the texts brought up to date."""
    return pii.pseudonymise(docs, key).withColumn("n_chars", F.char_length("text").cast("bigint"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every remaining text, and a digest of the bytes that they decode to."""
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    made = bpe.tokenise(docs, path, public_tokenizers.PATTERN)
    return made.select("doc_id", "ids", F.size("ids").cast("bigint").alias("n_tokens"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES: list[tuple[str, Stage]] = [
    ("quality", filter_quality),
    ("near_copies", drop_near_copies),
    ("decontaminate", drop_benchmarks),
    ("pseudonyms", pseudonymise),
    ("encode", encode),
]

# the classifier is fitted and the pseudonyms are keyed: SQL has neither
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = ship(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = fresh_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
