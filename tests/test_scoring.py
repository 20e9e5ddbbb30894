"""Scorers against values worked out by hand and against plain Python."""

import random
import re

import pytest
from pyspark.sql import functions as F

from lantern.functions import scoring
from lantern.functions.numbers import exact_round, fixed
from lantern.operators.evaluate import (
    compare_models,
    evaluate,
    numeric_metrics,
    with_code_explanation,
    with_code_score,
    with_length_statistics,
    with_math_explanation,
    with_math_score,
)


def column(spark, values, kind="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}").orderBy("i")


def apply(spark, values, expression, kind="string"):
    return [r[0] for r in column(spark, values, kind).select(expression(F.col("x"))).collect()]


LETTERS = {
    "B": "B", "b ": "B", "Answer: B": "B", "Answer B": "B", "Choice - D": "D", "(C)": "C", "[B]": "B",
    "\n D.": "D", "I": "I", "The answer is B": "H", "My answer: B": "A", "I think D": "H",
    "Die Antwort ist C": "D", "None": "E", "A or B": "A", "42": "4", "xyz": "X", "": "A",
    "**Answer: B**": "B", " c ": "C",
}


def test_letters(spark):
    assert apply(spark, list(LETTERS), scoring.answer_letter) == list(LETTERS.values())


def test_strict_letters(spark):
    texts = ["The answer is B", "A or B", "None", "(c)"]
    assert apply(spark, texts, lambda c: scoring.answer_letter(c, strict=True)) == ["B", "B", None, "C"]


def test_valid_letters(spark):
    rows = spark.createDataFrame(
        [(["x", "y", "z"], "C"), (["x", "y", "z"], "D"), ([], "D"), (None, "D"), (None, "E"), (["x"], "AB")],
        "c array<string>, l string",
    )
    out = rows.select(
        F.array_join(scoring.valid_letters(F.col("c")), ""), scoring.is_valid_letter(F.col("l"), F.col("c"))
    ).collect()
    assert [tuple(r) for r in out] == [
        ("ABC", True), ("ABC", False), ("ABCD", True), ("ABCD", True), ("ABCD", False), ("A", False),
    ]


NUMBERS = {
    "8": 8.0, "1,000": 1000.0, "so \\boxed{1,234.5} or 7": 1234.5, "\\boxed{x} 5": None, "5-3": 5.0,
    ".5": 5.0, "1e3": 1.0, "a-3": -3.0, "-7.25 deg": -7.25, "I have 3 of 4": 3.0, "10%": 10.0, "3.": 3.0,
    "1,00,0": 1000.0, "none": None, "": None,
}


def test_numbers(spark):
    assert apply(spark, list(NUMBERS), scoring.number) == list(NUMBERS.values())


def test_math(spark):
    cases = [
        ("99", "100", 1.0), ("101", "100", 1.0), ("98.9", "100", 0.0), ("0.005", "0", 1.0),
        ("0.02", "0", 0.0), ("\\boxed{x}", "\\boxed{X}", 1.0), ("no idea", "12", 0.0), (None, "12", None),
    ]
    df = spark.createDataFrame(cases, "predicted_answer string, gold_answer string, want double")
    rows = with_math_explanation(with_math_score(df)).collect()
    assert [r.math.score if r.math else None for r in rows] == [c[2] for c in cases]
    assert rows[2].explanation.interpretation == "✗ Difference (1.1000) exceeds tolerance (1.0000)"
    assert rows[5].explanation.interpretation == "✓ Exact match!"
    assert rows[7].explanation is None


def python_code(p, g):
    a, b = (set(re.findall(r"\w+", t.strip().lower())) for t in (p, g))
    return len(a & b) / len(a | b) if a and b else 0.0


def test_code(spark):
    cases = [
        ("def f(x): return x", "def f(x): return x"),
        ("", "a b"),
        ("a b c d e f g", "a b c d e f g h i j"),
        ("a b c d e f g h", "A B C D E F G h I J"),
        ("Été straße naïve_x 42", "été STRASSE 42"),
        ("x x x", "x"),
    ]
    df = spark.createDataFrame(cases, "predicted_answer string, gold_answer string")
    rows = with_code_explanation(with_code_score(df)).collect()
    for (p, g), r in zip(cases, rows):
        want = python_code(p, g)
        assert r.code.similarity == want
        assert r.code.score == (1.0 if want > 0.7 else 0.0)
        mark = "✓ Pass" if want > 0.7 else "✗ Fail"
        assert r.explanation.interpretation == f"{mark} (similarity: {want:.1%}, threshold: 70%)"
        # symmetric
        assert python_code(g, p) == want
    assert rows[2].code.score == 0.0  # exactly 0.7


def test_exact_match(spark):
    df = spark.createDataFrame([(" Paris\n", "paris"), ("Paris", "Rome")], "p string, g string")
    assert [r[0] for r in df.select(scoring.score_exact("p", "g").score).collect()] == [1.0, 0.0]


def test_dispatch(spark):
    rows = [
        ("mmlu", "B", "b", 1.0, "accuracy"),
        ("MMLU", "The answer is B", "B", 0.0, "accuracy"),
        ("gsm8k", "it is 8", "8", 1.0, "accuracy"),
        ("HumanEval", "return x", "return x", 1.0, "pass@1"),
        ("cnndailymail", "the cat sat on", "the cat sat on", 1.0, "ROUGE-Avg"),
        ("foo", " Paris\n", "paris", 1.0, "exact_match"),
        ("gsm8k", None, "8", None, None),
    ]
    df = spark.createDataFrame(rows, "dataset string, predicted_answer string, gold_answer string, s double, m string")
    found = {(r.dataset, r.predicted_answer): r for r in evaluate(df).collect()}
    out = [found[r[:2]] for r in rows]
    assert [(r.score, r.metric) for r in out] == [(r[3], r[4]) for r in rows] and len(found) == len(rows)
    assert out[2].details.math.explanation.interpretation == "✓ Within tolerance!"
    assert out[3].details.code.explanation.interpretation == "✓ Pass (similarity: 100.0%, threshold: 70%)"
    assert out[0].details.choice.is_valid_choice and out[0].details.math is None
    assert out[4].details.summary.rougeL_band == "Excellent"


def test_missing_column(spark):
    with pytest.raises(ValueError, match="missing required column: gold_answer"):
        evaluate(spark.createDataFrame([("a", "b")], "dataset string, predicted_answer string"))


def test_lengths(spark):
    df = spark.createDataFrame([("", ""), ("a b  c\n", "x"), ("a", "b c d e f g h i")], "p string, g string")
    out = [tuple(r.lengths) for r in with_length_statistics(df, "p", "g").collect()]
    assert out == [(0, 0, 0.0), (3, 1, 3.0), (1, 8, round(1 / 8, 2))]


def test_labels(spark):
    values = [0.0, 0.125, 0.285, 0.5, 0.995, 1.0]
    out = apply(spark, values, scoring.display_label, "double")
    assert [r.percent for r in out] == ["0%", "13%", "28%", "50%", "100%", "100%"]
    assert [r.verdict for r in out] == ["× Needs Review"] * 5 + ["✓ Perfect Match!"]
    assert apply(spark, [0.0625, 0.2825, 0.5], scoring.similarity_percent, "double") == ["6.3%", "28.2%", "50.0%"]


def test_bands_are_strict(spark):
    out = apply(spark, [0.51, 0.5, 0.31, 0.3], lambda c: scoring.quality_band(c, "rouge1"), "double")
    assert out == ["Excellent", "Good", "Good", "Needs improvement"]
    assert apply(spark, [0.41, 0.4, 0.2], lambda c: scoring.quality_band(c, "rouge2"), "double") == [
        "Excellent", "Good", "Needs improvement",
    ]


def test_exact_round(spark):
    rng = random.Random(3)
    values = [2.675, 0.125, 1.005, 0.05, -2.675, 0.03125, 0.0, 12345.678] + [
        rng.randint(0, 20000) / rng.choice([1, 3, 7, 8, 16, 40, 200, 400, 2000]) for _ in range(3000)
    ]
    for digits in (0, 1, 2, 4):
        assert apply(spark, values, lambda c: exact_round(c, digits), "double") == [
            round(v, digits) for v in values
        ]
    assert apply(spark, values, lambda c: fixed(c, 4), "double") == [f"{v:.4f}" for v in values]


def test_compare_models(spark):
    rows = [("d", "a", 1.0), ("d", "b", 0.0), ("e", "a", 0.5), ("e", "b", 0.5)]
    df = spark.createDataFrame(rows, "dataset string, model string, score double")
    out = {r.dataset: (r.a, r.b, r.best_model) for r in compare_models(df, ["a", "b"]).collect()}
    assert out == {"d": (1.0, 0.0, "a"), "e": (0.5, 0.5, "a")}


def test_rounding_of_large_values(spark):
    values = [4.2e16, 9.1e14, 9.3e14, 1e15 + 0.5, 4503599627370497.5, 2.0**53 + 2, 1e17 + 16, 1e20, 1.7e308, -4.2e16, 900719925474.09915, 0.0]
    values += [10.0**e * m for e in range(8, 21) for m in (1.2345678901234567, -7.654321987654321)]
    for digits in (2, 4):
        assert apply(spark, values, lambda c: exact_round(c, digits), "double") == [round(v, digits) for v in values]


def test_models_without_scores_come_last(spark):
    rows = [("d", "a", None), ("d", "b", 0.9), ("e", "a", 0.0), ("f", "b", None)]
    out = {r.dataset: (r.best_model, r.ranking) for r in compare_models(spark.createDataFrame(rows, "dataset string, model string, score double"), ["a", "b"]).collect()}
    assert out == {"d": ("b", ["b"]), "e": ("a", ["a"]), "f": (None, [])}


def test_numeric_metrics(spark):
    df = spark.createDataFrame([("a", "1.23456"), ("b", "good"), ("c", "7")], "key string, value string")
    assert {r.key: r.value for r in numeric_metrics(df).collect()} == {"a": 1.2346, "c": 7.0}


def test_summaries_are_not_passed_over(spark):
    df = spark.createDataFrame([("CNNDailyMail", "a b", "a b")], "dataset string, predicted_answer string, gold_answer string")
    assert evaluate(df).first().score == 1.0
    with pytest.raises(Exception, match="summaries=True"):
        evaluate(df, summaries=False).collect()
