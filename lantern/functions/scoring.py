"""Scorers E1-E10 and E15-E18 as columns: everything here stays inside the JVM and is row-local."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lantern.functions.numbers import exact_round, fixed
from lantern.functions.text import SPACE_CLASS, col, fields, strip, words
from lantern.sources.fixed_values import (
    BAND_LIMITS,
    BAND_TEXTS,
    CODE_THRESHOLD,
    FAMILY_DATASETS,
    TOLERANCE,
)

# The patterns that decide which part of an answer counts.
LETTER_PATTERN = (
    rf"(?:ANSWER|CHOICE)?[{SPACE_CLASS}]*[:\-]?[{SPACE_CLASS}]*\(?([A-H])\)?"
)
STRICT_LETTER_PATTERN = r"\b([A-H])\b"
BOXED_PATTERN = r"\\boxed\{([^}]+)\}"
NUMBER_PATTERN = r"-?\d+(?:\.\d+)?"


def answer_letter(text: Column | str, strict: bool = False) -> Column:
    """The letter an answer stands for.

    The default takes the first A-H anywhere, even inside a word. ``strict`` takes the last letter
    that stands alone and is null without one.
    """
    upper = F.upper(strip(text))
    if strict:
        alone = F.regexp_extract_all(upper, F.lit(STRICT_LETTER_PATTERN), F.lit(1))
        return F.try_element_at(alone, F.lit(-1))
    found = F.nullif(F.regexp_extract(upper, LETTER_PATTERN, 1), F.lit(""))
    first = F.nullif(F.substring(upper, 1, 1), F.lit(""))
    return F.when(upper.isNotNull(), F.coalesce(found, first, F.lit("A")))


def valid_letters(choices: Column | None) -> Column:
    """One letter per choice; A-D for missing or empty choices."""
    four = F.array(*[F.lit(x) for x in "ABCD"])
    if choices is None:
        return four
    lettered = F.transform(choices, lambda _, i: F.char(F.lit(65) + i))
    return F.when(F.size(choices) > 0, lettered).otherwise(four)


def is_valid_letter(letter: Column, choices: Column | None) -> Column:
    """Whether a letter names a choice, without building the list of letters."""
    count = F.lit(4)
    if choices is not None:
        count = F.when(F.size(choices) > 0, F.size(choices)).otherwise(F.lit(4))
    at = F.ascii(letter) - 65
    return F.coalesce((F.length(letter) == 1) & (at >= 0) & (at < count), F.lit(False))


def number(text: Column | str) -> Column:
    """First number of an answer, the content of ``\\boxed{}`` first, commas ignored (E5)."""
    text = col(text)
    boxed = F.nullif(F.regexp_extract(text, BOXED_PATTERN, 1), F.lit(""))
    plain = F.replace(F.coalesce(boxed, text), F.lit(","), F.lit(""))
    return F.regexp_extract(plain, NUMBER_PATTERN, 0).try_cast("double")


def mark(right: Column) -> Column:
    return F.when(right, F.lit(1.0)).otherwise(F.lit(0.0))


def score_choice(
    predicted: Column | str,
    gold: Column | str,
    choices: Column | str | None = None,
    strict: bool = False,
) -> Column:
    """Multiple choice (E3, E4, E17) as a struct."""
    letter = answer_letter(predicted, strict)
    right = F.upper(strip(gold))
    offered = None if choices is None else col(choices)
    score = mark(letter.eqNullSafe(right))
    made = F.struct(
        score.alias("score"),
        F.lit("accuracy").alias("metric"),
        letter.alias("extracted_answer"),
        right.alias("correct_letter"),
        is_valid_letter(letter, offered).alias("is_valid_choice"),
        valid_letters(offered).alias("valid_choices"),
        F.when(score == 1.0, "✓ Correct answer!")
        .otherwise("✗ Incorrect answer")
        .alias("interpretation"),
    )
    return F.when(col(predicted).isNotNull(), made)


def score_math(
    predicted: Column | str,
    gold: Column | str,
    predicted_number: Column | str | None = None,
    gold_number: Column | str | None = None,
) -> Column:
    """Numeric answer within one percent, or equal text when a number is missing.

    The two numbers are used many times. Pass columns that hold them, as ``evaluate`` does, so that
    the patterns run once per row.
    """
    p = number(predicted) if predicted_number is None else col(predicted_number)
    g = number(gold) if gold_number is None else col(gold_number)
    numeric = p.isNotNull() & g.isNotNull()
    limit = F.when(g != 0, F.abs(g) * TOLERANCE).otherwise(F.lit(TOLERANCE))
    away = F.abs(p - g)
    p_text, g_text = F.lower(strip(predicted)), F.lower(strip(gold))
    score = F.when(numeric, mark(away <= limit)).otherwise(mark(p_text == g_text))
    made = F.struct(
        score.alias("score"),
        F.lit("accuracy").alias("metric"),
        F.when(numeric, "numeric_match").otherwise("string_match").alias("method"),
        p.alias("predicted_number"),
        g.alias("gold_number"),
        F.when(~numeric, p_text).alias("predicted_text"),
        F.when(~numeric, g_text).alias("gold_text"),
        F.when(numeric, away).alias("difference"),
        F.when(numeric, limit).alias("tolerance"),
    )
    return F.when(col(predicted).isNotNull(), made)


def explain_math(scored: Column) -> Column:
    """Rounded values and the sentence shown beside a :func:`score_math` result."""
    far = F.format_string(
        "✗ Difference (%s) exceeds tolerance (%s)",
        fixed(scored.difference, 4),
        fixed(scored.tolerance, 4),
    )
    right, numeric = scored.score == 1.0, scored.method == "numeric_match"
    made = F.struct(
        exact_round(scored.difference, 4).alias("absolute_difference"),
        exact_round(scored.tolerance, 4).alias("tolerance"),
        F.when(numeric & right, "✓ Within tolerance!")
        .when(numeric, far)
        .when(right, "✓ Exact match!")
        .otherwise("✗ Strings don't match")
        .alias("interpretation"),
    )
    return F.when(scored.isNotNull(), made)


def code_tokens(text: Column | str) -> Column:
    """Distinct word tokens of a trimmed text."""
    return F.array_distinct(words(strip(text)))


def score_code(
    predicted: Column | str,
    gold: Column | str,
    predicted_tokens: Column | str | None = None,
    gold_tokens: Column | str | None = None,
    common: Column | str | None = None,
) -> Column:
    """Token overlap strictly above the threshold.

    Token sets and the size of what they share are used many times. Pass columns that hold them, as
    ``evaluate`` does, so that they are built once per row.
    """
    a = code_tokens(predicted) if predicted_tokens is None else col(predicted_tokens)
    b = code_tokens(gold) if gold_tokens is None else col(gold_tokens)
    shared = F.size(F.array_intersect(a, b)) if common is None else col(common)
    # the union has as many tokens as both sets less those they share
    similarity = F.when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0)).otherwise(
        shared / (F.size(a) + F.size(b) - shared)
    )
    made = F.struct(
        mark(similarity > CODE_THRESHOLD).alias("score"),
        F.lit("pass@1").alias("metric"),
        similarity.alias("similarity"),
        shared.alias("common_tokens"),
        F.size(a).alias("predicted_tokens"),
        F.size(b).alias("gold_tokens"),
        F.length(strip(predicted)).alias("predicted_length"),
        F.length(strip(gold)).alias("gold_length"),
    )
    return F.when(col(predicted).isNotNull(), made)


def explain_code(scored: Column) -> Column:
    """Rounded similarity and the sentence shown beside a :func:`score_code` result."""
    made = F.struct(
        exact_round(scored.similarity, 4).alias("similarity"),
        F.concat(
            F.when(scored.score == 1.0, "✓ Pass").otherwise("✗ Fail"),
            F.format_string(" (similarity: %s%%, threshold: 70%%)", fixed(scored.similarity * 100, 1)),
        ).alias("interpretation"),
    )
    return F.when(scored.isNotNull(), made)


def score_exact(predicted: Column | str, gold: Column | str) -> Column:
    """Equal after trimming and lower-casing."""
    same = F.lower(strip(predicted)) == F.lower(strip(gold))
    made = F.struct(
        mark(same).alias("score"),
        F.lit("exact_match").alias("metric"),
        F.lit("exact_match").alias("method"),
    )
    return F.when(col(predicted).isNotNull(), made)


def scorer_family(dataset: Column | str) -> Column:
    """Which scorer a data set name calls for, whatever its case."""
    name = F.upper(col(dataset))
    chain = F.when(F.lit(False), F.lit(""))
    for family, names in FAMILY_DATASETS.items():
        chain = chain.when(name.isin(*[n.upper() for n in names]), F.lit(family))
    return chain.otherwise(F.lit("exact"))


def quality_band(f1: Column | str, metric: str) -> Column:
    """Excellent / Good / Needs improvement for one overlap metric."""
    best, good = BAND_LIMITS[metric]
    return (
        F.when(col(f1) > best, "Excellent")
        .when(col(f1) > good, "Good")
        .otherwise("Needs improvement")
    )


def band_text(f1: Column | str, metric: str) -> Column:
    """The band with what it is said of, as shown beside a metric."""
    return F.concat_ws(" ", quality_band(f1, metric), F.lit(BAND_TEXTS[metric]))


def word_count(text: Column | str) -> Column:
    """Pieces of a text between white space; none in an empty one."""
    return F.size(fields(text))


def length_statistics(predicted_words: Column | str, gold_words: Column | str) -> Column:
    """Word counts, given as columns, and their ratio to two decimals."""
    p, g = col(predicted_words), col(gold_words)
    return F.struct(
        p.cast("int").alias("predicted_length"),
        g.cast("int").alias("reference_length"),
        exact_round(p / F.greatest(g, F.lit(1)), 2).alias("length_ratio"),
    )


def display_label(score: Column | str) -> Column:
    """Percent without decimals and the verdict shown with it."""
    score = col(score)
    return F.struct(
        F.concat(F.round(score * 100, 0).cast("bigint").cast("string"), F.lit("%")).alias("percent"),
        F.when(score == 1.0, "✓ Perfect Match!").otherwise("× Needs Review").alias("verdict"),
    )


def similarity_percent(similarity: Column | str) -> Column:
    """Code similarity as a percentage with one decimal."""
    return F.concat(fixed(col(similarity) * 100, 1, "up"), F.lit("%"))
