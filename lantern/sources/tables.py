"""Readers and writers."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lantern.sources.fixed_values import PREFERENCE_SETS


def read_text_documents(spark: SparkSession, directory: str) -> DataFrame:
    """Every ``.txt`` file of one directory as one document; directories below it are not read."""
    # Spark lists a partition-like directory recursively unless told otherwise
    return (
        spark.read.option("pathGlobFilter", "*.txt")
        .option("recursiveFileLookup", "false")
        .text(directory, wholetext=True)
        .select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))
    )


def read_prices(spark: SparkSession, path: str, symbols: list[str] | DataFrame | None = None) -> DataFrame:
    """Daily price histories, of all symbols or of some.

    A list is for a few symbols: the filter reaches the scan. A table of them (column ``symbol``, repeats and
    nulls do no harm) may be of any size: it is joined, and nothing of it comes to the driver.
    """
    prices = spark.read.parquet(path)
    missing = {"symbol", "ts", "close"} - set(prices.columns)
    if missing:
        raise ValueError(f"Price history lacks columns: {sorted(missing)}")
    if isinstance(symbols, DataFrame):
        return prices.join(symbols.select("symbol"), "symbol", "left_semi")
    return prices if symbols is None else prices.where(F.col("symbol").isin(symbols))


def directory_name(name: str) -> str:
    return name.replace("/", "_")


@dataclass(frozen=True)
class Splits:
    """A loaded preference set and the names of its two splits."""

    data: DataFrame
    train: str
    test: str


def load_preferences(
    spark: SparkSession,
    base: str,
    name: str | None,
    subset: str | None = None,
    train_split: str = "train",
    test_split: str = "test",
) -> Splits:
    """A saved preference set by catalog alias or by its own name (S3).

    The catalog may name other splits. A set without its train split is an error that lists the
    splits there are.
    """
    if not name:
        raise ValueError("No dataset name provided")
    for alias, source, *_, own_train, own_test in PREFERENCE_SETS:
        if alias == name:
            name = source
            train_split, test_split = own_train or train_split, own_test or test_split
    path = f"{base}/{directory_name(name)}" + (f"/{subset}" if subset else "")
    data = spark.read.parquet(path)
    # the split is a partition column: this looks into one directory
    if data.where(F.col("split") == train_split).isEmpty():
        have = sorted(r[0] for r in data.select("split").distinct().collect())
        raise ValueError(f"Train split '{train_split}' not found in dataset. Available splits: {have}")
    return Splits(data, train_split, test_split)


def save_dataset(df: DataFrame, base: str, name: str, split: str = "split", mode: str = "overwrite") -> str:
    """A data set below ``base``, one directory per split; ``/`` in its name becomes ``_``."""
    path = f"{base}/{directory_name(name)}"
    df.write.mode(mode).partitionBy(split).parquet(path)
    return path


def append_metrics(df: DataFrame, path: str) -> None:
    """Metrics (run, key, value) appended to a table."""
    df.select("run", "key", F.col("value").cast("string").alias("value")).write.mode("append").parquet(path)


def append_history(scored: DataFrame, path: str, run: str) -> None:
    """Scored rows kept under their run, one partition per run (A3)."""
    scored.withColumn("run", F.lit(run)).write.mode("append").partitionBy("run").parquet(path)


CSV = {"escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def export(df: DataFrame, path: str, kind: str) -> str:
    """Results as CSV with a header or as JSON lines (A4)."""
    if kind == "csv":
        # a text survives whole only with its quotes doubled and the white space at its ends kept
        df.write.mode("overwrite").options(**CSV).csv(path, header=True)
    elif kind == "json":
        df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)
    else:
        raise ValueError(f"Unknown export format: {kind}. Available: csv, json")
    return path


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A CSV export read back."""
    return spark.read.options(**CSV).csv(path, schema=schema, header=True, multiLine=True)
