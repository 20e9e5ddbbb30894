"""Scoring whole tables (E1) and the reports over scored rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lantern.functions.numbers import exact_round
from lantern.functions.scoring import (
    code_tokens,
    explain_code,
    explain_math,
    length_statistics,
    number,
    score_choice,
    score_code,
    score_exact,
    score_math,
    scorer_family,
    word_count,
)
from lantern.operators.overlap import with_summary_score
from lantern.operators.ranking import first_per_group

EXAMPLE_COLUMNS = ["dataset", "prompt", "system_prompt", "choices", "gold_answer"]


def check_columns(df: DataFrame, needed: Sequence[str]) -> None:
    for name in needed:
        if name not in df.columns:
            raise ValueError(f"Dataset missing required column: {name}")


def evaluate(
    df: DataFrame,
    dataset: str = "dataset",
    predicted: str = "predicted_answer",
    gold: str = "gold_answer",
    choices: str | None = None,
    summaries: bool = True,
) -> DataFrame:
    """``df`` plus score, metric and details (one nullable struct per scorer family).

    A null prediction (its generation failed) keeps its row with null score. Every row is scored where it is,
    in a table as in a stream. ``summaries=False`` leaves the Python step of stems out of the plan for tables
    known to hold no summarisation rows; such a row is an error then, not a row without a score. Details of
    numbers and code carry their explanations; nothing is computed for details not read.
    """
    check_columns(df, [dataset, predicted, gold])

    def only(family: str, value: Column) -> Column:
        return F.when(F.col("_family") == family, value)

    # in steps, so that a pattern runs and a token set is built once per row, and only where needed
    once = {
        "_p": only("math", number(predicted)),
        "_g": only("math", number(gold)),
        "_a": only("code", code_tokens(predicted)),
        "_b": only("code", code_tokens(gold)),
    }
    details = {
        "choice": only("choice", score_choice(predicted, gold, choices)),
        "math": only("math", score_math(predicted, gold, "_p", "_g")),
        "code": only("code", score_code(predicted, gold, "_a", "_b", "_n")),
        "exact": only("exact", score_exact(predicted, gold)),
    }
    if summaries:
        # rows of other families have nulls there, which cost nothing
        once |= {f"_text_{c}": only("summary", F.col(c)) for c in (predicted, gold)}
    scored = (
        df.withColumn("_family", scorer_family(dataset))
        .withColumns(once)
        .withColumn("_n", F.size(F.array_intersect("_a", "_b")))
        .withColumns({f"_{name}": value for name, value in details.items()})
    )
    if summaries:
        scored = with_summary_score(scored, f"_text_{predicted}", f"_text_{gold}", "_summary")
        details["summary"] = F.col("_summary")
    no_summaries = F.raise_error(F.lit("a summarisation row needs summaries=True")).cast("double")
    refused = [] if summaries else [F.when(F.col("_family") == "summary", no_summaries)]
    shown = {name: F.col(f"_{name}") for name in details}
    for name, explain in (("math", explain_math), ("code", explain_code)):
        shown[name] = shown[name].withField("explanation", explain(F.col(f"_{name}")))
    return scored.select(
        *[F.col(f"`{c}`") for c in df.columns if c not in ("score", "metric", "details")],
        F.coalesce(*[F.col(f"_{name}.score") for name in details], *refused).alias("score"),
        F.coalesce(*[F.col(f"_{name}.metric") for name in details]).alias("metric"),
        F.struct(*[value.alias(name) for name, value in shown.items()]).alias("details"),
    )


def with_math_score(
    df: DataFrame, predicted: str = "predicted_answer", gold: str = "gold_answer", name: str = "math"
) -> DataFrame:
    """``df`` plus the numeric score, for tables of numeric answers alone: numbers first."""
    numbers = df.withColumns({"_p": number(predicted), "_g": number(gold)})
    return numbers.withColumn(name, score_math(predicted, gold, "_p", "_g")).drop("_p", "_g")


def with_code_score(
    df: DataFrame, predicted: str = "predicted_answer", gold: str = "gold_answer", name: str = "code"
) -> DataFrame:
    """``df`` plus the code score, for tables of code alone: token sets first."""
    sets = df.withColumns({"_a": code_tokens(predicted), "_b": code_tokens(gold)})
    shared = sets.withColumn("_n", F.size(F.array_intersect("_a", "_b")))
    scored = shared.withColumn(name, score_code(predicted, gold, "_a", "_b", "_n"))
    return scored.drop("_a", "_b", "_n")


def with_code_explanation(df: DataFrame, scored: str = "code", name: str = "explanation") -> DataFrame:
    """The explanation beside a code score."""
    return df.withColumn(name, explain_code(F.col(scored)))


def with_length_statistics(df: DataFrame, predicted: str, gold: str, name: str = "lengths") -> DataFrame:
    """Word counts and their ratio (E16): each text is cut into words once."""
    counted = df.withColumns({"_pw": word_count(predicted), "_gw": word_count(gold)})
    return counted.withColumn(name, length_statistics("_pw", "_gw")).drop("_pw", "_gw")


def with_math_explanation(df: DataFrame, scored: str = "math", name: str = "explanation") -> DataFrame:
    """The explanation beside a numeric score, kept out of the scoring plan unless it is wanted."""
    return df.withColumn(name, explain_math(F.col(scored)))


def accuracy(df: DataFrame, by: Sequence[str], totals: bool = False) -> DataFrame:
    """Rows, scored rows and mean score per group, optionally with subtotals (A1)."""
    grouped = df.rollup(*by) if totals else df.groupBy(*by)
    return grouped.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count("score").alias("scored"),
        F.avg("score").alias("mean_score"),
    )


def compare_models(
    df: DataFrame, models: Sequence[str], dataset: str = "dataset", model: str = "model"
) -> DataFrame:
    """One row per data set, a mean score per model, ``ranking`` (the scored models, best first, equal
    ones by name) and the best model's name, null if none has a score (A2)."""
    wide = df.groupBy(dataset).pivot(model, list(models)).agg(F.avg("score"))
    scored = F.filter(
        F.array(*[F.struct((-F.col(f"`{m}`")).alias("s"), F.lit(m).alias("m")) for m in models]),
        lambda z: z.s.isNotNull(),
    )
    ranked = wide.withColumn("ranking", F.transform(F.array_sort(scored), lambda z: z.m))
    return ranked.withColumn("best_model", F.get("ranking", F.lit(0)))


def latest_results(df: DataFrame, key: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The newest row of every key in an appended history (A3)."""
    return first_per_group(df, key, order, 1, "_place").drop("_place")


def numeric_metrics(df: DataFrame, key: str = "key", value: str = "value") -> DataFrame:
    """Metrics that are numbers, to four decimals."""
    number = F.col(value).try_cast("double")
    return df.where(number.isNotNull()).withColumn(value, exact_round(number, 4))
