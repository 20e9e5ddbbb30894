"""Raw benchmark tables -> one Example schema (P0-P9), prompts (P10-P13) and sampling."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lantern.functions.text import col, md5_order, strip
from lantern.operators.ranking import first_per_group, first_rows
from lantern.sources.fixed_values import (
    BASELINE_CODE,
    BASELINE_OTHER,
    BENCHMARK_PREFIX,
    CHOICE_MARKS,
    CODE_WORDS,
    MATH_WORDS,
    RETRIEVAL_BEFORE_CONTEXT,
    RETRIEVAL_BEFORE_QUESTION,
    SYSTEM_PROMPTS,
)

ARTICLE_CHARS = 3000


def lettered(header: str, text: Column, choices: Column) -> Column:
    """Question with its choices as ``A. …`` lines."""
    lines = F.transform(choices, lambda c, i: F.concat(F.char(F.lit(65) + i), F.lit(". "), c, F.lit("\n")))
    return F.concat(F.lit(header), text, F.lit("\n\n"), F.array_join(lines, ""), F.lit("\nAnswer:"))


def letter(index: Column) -> Column:
    return F.char(F.lit(65) + index)


def optional(df: DataFrame, name: str, default: str) -> Column:
    """A metadata column, its default where the column or the value is missing."""
    return F.coalesce(F.col(f"`{name}`"), F.lit(default)) if name in df.columns else F.lit(default)


def metadata(**pairs: Column) -> Column:
    flat = [part for k, v in pairs.items() for part in (F.lit(k), v.cast("string"))]
    return F.create_map(*flat)


def as_examples(
    df: DataFrame,
    dataset: str,
    keep: list[str],
    prompt: Column,
    gold: Column,
    notes: Column,
    choices: Column | None = None,
) -> DataFrame:
    return df.select(
        *keep,
        F.lit(dataset).alias("dataset"),
        prompt.alias("prompt"),
        F.lit(SYSTEM_PROMPTS[dataset]).alias("system_prompt"),
        (F.lit(None).cast("array<string>") if choices is None else choices).alias("choices"),
        gold.alias("gold_answer"),
        notes.alias("metadata"),
    )


def mmlu(df: DataFrame, keep: list[str], seed: int) -> DataFrame:
    """question, choices, answer INT, subject."""
    return as_examples(
        df,
        "MMLU",
        keep,
        lettered("Question: ", F.col("question"), F.col("choices")),
        letter(F.col("answer").cast("int")),
        metadata(subject=optional(df, "subject", "unknown")),
        F.col("choices"),
    )


def gsm8k(df: DataFrame, keep: list[str], seed: int) -> DataFrame:
    """question, answer ending in ``#### number``."""
    return as_examples(
        df,
        "GSM8K",
        keep,
        F.concat(F.lit("Question: "), F.col("question"), F.lit("\n\nProvide your answer as a number.")),
        strip(F.substring_index("answer", "####", -1)),
        metadata(full_solution=F.col("answer")),
    )


def humaneval(df: DataFrame, keep: list[str], seed: int) -> DataFrame:
    """prompt, canonical_solution, task_id, test, entry_point."""
    return as_examples(
        df,
        "HumanEval",
        keep,
        F.col("prompt"),
        F.col("canonical_solution"),
        metadata(task_id=F.col("task_id"), test=F.col("test"), entry_point=F.col("entry_point")),
    )


def hellaswag(df: DataFrame, keep: list[str], seed: int) -> DataFrame:
    """ctx, endings, label as text, activity_label."""
    return as_examples(
        df,
        "HellaSwag",
        keep,
        lettered("Context: ", F.col("ctx"), F.col("endings")),
        letter(F.col("label").cast("int")),
        metadata(activity_label=optional(df, "activity_label", "")),
        F.col("endings"),
    )


def truthfulqa(df: DataFrame, keep: list[str], seed: int) -> DataFrame:
    """question, mc1_targets STRUCT<choices, labels>, category; the first label 1 is right (P5)."""
    first_right = F.array_position("mc1_targets.labels", F.lit(1)).cast("int") - 1
    return as_examples(
        df,
        "TruthfulQA",
        keep,
        lettered("Question: ", F.col("question"), F.col("mc1_targets.choices")),
        letter(F.greatest(first_right, F.lit(0))),
        metadata(category=optional(df, "category", "unknown")),
        F.col("mc1_targets.choices"),
    )


def gpqa(df: DataFrame, keep: list[str], seed: int) -> DataFrame:
    """Three wrong answers and the right one in seeded order (P6). ``keep`` names the row's id, from which
    its order is drawn."""
    if not keep:
        raise ValueError("GPQA needs the column that identifies a row, to draw the order of its answers")
    named = ["Incorrect Answer 1", "Incorrect Answer 2", "Incorrect Answer 3", "Correct Answer"]
    dealt = [
        F.struct(md5_order(seed, *keep, F.lit(i)).alias("at"), F.col(f"`{n}`").alias("text"))
        for i, n in enumerate(named)
    ]
    shuffled = df.withColumn("_choices", F.transform(F.array_sort(F.array(*dealt)), lambda z: z.text))
    right = F.array_position("_choices", F.col("`Correct Answer`")).cast("int") - 1
    return as_examples(
        shuffled,
        "GPQA",
        keep,
        lettered("Question: ", F.col("Question"), F.col("_choices")),
        letter(right),
        metadata(subdomain=optional(df, "Subdomain", "unknown")),
        F.col("_choices"),
    )


def cnndailymail(df: DataFrame, keep: list[str], seed: int) -> DataFrame:
    """article, highlights; a long article is cut in the prompt, as the feature has it."""
    article = F.when(
        F.length("article") > ARTICLE_CHARS,
        F.concat(F.substring("article", 1, ARTICLE_CHARS), F.lit("...")),
    ).otherwise(F.col("article"))
    return as_examples(
        df,
        "CNNDailyMail",
        keep,
        F.concat(F.lit("Article: "), article, F.lit("\n\nProvide a concise summary (2-4 sentences):")),
        F.col("highlights"),
        metadata(article_length=F.length("article"), summary_length=F.length("highlights")),
    )


BUILDERS: dict[str, Callable[[DataFrame, list[str], int], DataFrame]] = {
    "MMLU": mmlu,
    "GSM8K": gsm8k,
    "HumanEval": humaneval,
    "HellaSwag": hellaswag,
    "TruthfulQA": truthfulqa,
    "GPQA": gpqa,
    "CNNDailyMail": cnndailymail,
}


def build(dataset: str, raw: DataFrame, keep: list[str], seed: int = 42) -> DataFrame:
    """Examples of one benchmark; names are case-sensitive and an unknown one is an error."""
    if dataset not in BUILDERS:
        raise ValueError(f"Dataset {dataset} not supported; one of {', '.join(BUILDERS)}")
    return BUILDERS[dataset](raw, keep, seed)


def leading_rows(dataset: str, raw: DataFrame, key: str) -> DataFrame:
    """The rows of a benchmark that are held: its first 100 or 200, or all."""
    return first_rows(raw, BENCHMARK_PREFIX[dataset], key)


def sample(df: DataFrame, key: str, n: int = 1, seed: int = 42, per: list[str] | None = None) -> DataFrame:
    """``n`` rows drawn uniformly without replacement, per group if asked."""
    drawn = df.withColumn("_draw", md5_order(seed, key))
    if per:
        chosen = first_per_group(drawn, per, [F.col("_draw"), F.col(key)], n, "_place").drop("_place")
    else:
        chosen = first_rows(drawn, n, "_draw", F.col(key))
    return chosen.drop("_draw")


def full_prompt(prompt: Column | str, system: Column | str) -> Column:
    """System prompt, blank line, prompt; the prompt alone without a system prompt (P10)."""
    system, prompt = col(system), col(prompt)
    return F.when(system != "", F.concat(system, F.lit("\n\n"), prompt)).otherwise(prompt)


def question_prompt(context: Column | str, question: Column | str) -> Column:
    """The user message of a retrieval answer."""
    return F.concat(
        F.lit(RETRIEVAL_BEFORE_CONTEXT), col(context), F.lit(RETRIEVAL_BEFORE_QUESTION), col(question)
    )


def any_of(text: Column, marks: list[str]) -> Column:
    found = F.lit(False)
    for m in marks:
        found = found | F.contains(text, F.lit(m))
    return found


def prompt_kind(prompt: Column | str) -> Column:
    """multiple_choice, math, code or other: the first rule that hits."""
    prompt = col(prompt)
    lower = F.lower(prompt)
    return (
        F.when(any_of(prompt, CHOICE_MARKS), "multiple_choice")
        .when(any_of(lower, MATH_WORDS), "math")
        .when(any_of(lower, CODE_WORDS), "code")
        .otherwise("other")
    )


def baseline_answer(prompt: Column | str, key: Column | str, seed: int = 42) -> Column:
    """A canned answer by kind of prompt; random ones are drawn from seed and key."""
    kind, draw = prompt_kind(prompt), md5_order(seed, key)
    return (
        F.when(kind == "multiple_choice", F.char(F.lit(65) + draw % 4))
        .when(kind == "math", (draw % 100 + 1).cast("string"))
        .when(kind == "code", F.lit(BASELINE_CODE))
        .otherwise(F.lit(BASELINE_OTHER))
    )
