"""Benchmark and preference-set catalogs as small dimension tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lantern.sources.fixed_values import (
    BENCHMARKS,
    METRIC_TEXTS,
    PREFERENCE_SETS,
    SYSTEM_PROMPTS,
)


def benchmarks(spark: SparkSession) -> DataFrame:
    """Seven rows: name, description, task type, system prompt."""
    return spark.createDataFrame(
        [(*row, SYSTEM_PROMPTS[row[0]]) for row in BENCHMARKS],
        "name string, description string, task_type string, system_prompt string",
    )


def preference_sets(spark: SparkSession) -> DataFrame:
    """Six rows: alias, source, type, description, columns, size and split names."""
    return spark.createDataFrame(
        PREFERENCE_SETS,
        "alias string, source string, type string, description string, columns array<string>, "
        "size string, train_split string, test_split string",
    )


def metric_texts(spark: SparkSession) -> DataFrame:
    """The explanations shown beside a score."""
    return spark.createDataFrame(
        METRIC_TEXTS,
        "family string, name string, description string, calculation string, how_it_works string, note string",
    )


def with_benchmark(df: DataFrame, dataset: str = "dataset") -> DataFrame:
    """``df`` with task type and system prompt of its data set, case-insensitively. The catalog is
    seven rows, so it is broadcast."""
    known = benchmarks(df.sparkSession).select(
        F.upper("name").alias("_name"), "task_type", "description", "system_prompt"
    )
    return df.join(F.broadcast(known), F.upper(F.col(dataset)) == F.col("_name"), "left").drop("_name")


def split_report(df: DataFrame, split: str = "split") -> DataFrame:
    """Rows per split and the column names."""
    names = ", ".join(c for c in df.columns if c != split)
    return df.groupBy(split).agg(F.count(F.lit(1)).alias("rows")).withColumn("columns", F.lit(names))
