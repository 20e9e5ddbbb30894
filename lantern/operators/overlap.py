"""Overlap of text pairs: ROUGE, BLEU and summary scores (E11-E14, E16), row by row.

The n-grams of both texts are hashed, sorted together and counted off against each other in SQL expressions, so
nothing is shuffled and a stream is scored like a table. Only stems and the longest common subsequence are
functions of Python, in one pass.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lantern.functions.numbers import exact_round
from lantern.functions.overlap import common_length, score_summary, stem
from lantern.functions.text import SLICE_WORDS, fields, in_slices, strip

# shorter words have no stem of their own
SHORT_WORD = 3

PARTS = ("precision", "recall", "f1")


def rouge_words(text: Column | str) -> Column:
    """The runs of ASCII letters and digits of a lower-cased text, in order."""
    return F.regexp_extract_all(F.lower(text), F.lit("[a-z0-9]+"), F.lit(0))


def stems_and_lcs(stemmed: bool, lcs: bool) -> Callable:
    """A function of two arrays of words: their stems (if asked for) and their longest common subsequence."""

    def words(each) -> list[str]:
        return [stem(w) if len(w) > SHORT_WORD else w for w in each] if stemmed else list(each)

    def pair(a: list[str] | None, b: list[str] | None) -> tuple:
        if a is None or b is None:
            return None, None, None
        a, b = words(a), words(b)
        return a if stemmed else None, b if stemmed else None, common_length(a, b) if lcs else None

    @F.arrow_udf("rp array<string>, rg array<string>, lcs bigint")
    def made(parts: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        kinds = [pa.list_(pa.string()), pa.list_(pa.string()), pa.int64()]
        for batch in parts:
            for p, g in in_slices(batch, SLICE_WORDS):
                values = zip(*map(pair, p, g))
                yield pa.StructArray.from_arrays([pa.array(v, kind) for v, kind in zip(values, kinds)], ["rp", "rg", "lcs"])

    return made


def with_rouge_words(df: DataFrame, predicted: Column, gold: Column, stemmed: bool, lcs: bool) -> DataFrame:
    """``df`` with arrays ``rp`` and ``rg`` and, if asked for, ``lcs``; null where either text is."""
    rows = df.withColumns({"rp": rouge_words(predicted), "rg": rouge_words(gold)})
    if not (stemmed or lcs):
        return rows
    made = rows.withColumn("_made", stems_and_lcs(stemmed, lcs)("rp", "rg"))
    return made.withColumns({c: F.col(f"_made.{c}") for c in (("rp", "rg", "lcs") if stemmed else ("lcs",))}).drop("_made")


def apart(made: Callable[[Column], Column], **columns: Column | str) -> Column:
    """``made`` of a struct of columns, evaluated by itself. As part of a stage's generated method these
    expressions make it larger than the JVM compiles, and the whole stage is then interpreted."""
    of = F.struct(*[(F.col(c) if isinstance(c, str) else c).alias(name) for name, c in columns.items()])
    return F.transform(F.array(of), made)[0]


def longer(hashes: str, words: str, n: int) -> Column:
    """Hashes of the n-grams from those of one word less (``hashes``) and of the single words (``words``)."""

    def made(x: Column) -> Column:
        count = F.greatest(F.size(x.words) - (n - 1), F.lit(0))
        return F.zip_with(F.slice(x.hashes, F.lit(1), count), F.slice(x.words, F.lit(n), count), lambda a, b: F.xxhash64(a, b))

    return apart(made, hashes=hashes, words=words)


def counted_off(p: str, g: str) -> Column:
    """How many elements two arrays of hashes share, each as often as both have it.

    One sort of both, the side in the lowest bit, puts equal ones together, those of ``p`` first; then each of
    ``g`` uses up one of ``p``. Two n-grams of a pair are taken for the same with a chance of 2^-63.
    """

    def sided(hashes: Column, side: int) -> Column:
        bit = F.lit(side).cast("bigint")
        return F.transform(hashes, lambda h: F.shiftleft(h, 1).bitwiseOR(bit))

    start = F.struct(F.lit(0).cast("bigint").alias("gram"), F.lit(0).alias("open"), F.lit(0).alias("hits"))

    def step(state: Column, x: Column) -> Column:
        gram, of_gold = F.shiftrightunsigned(x, 1), x.bitwiseAND(F.lit(1).cast("bigint")) == 1
        same = state.gram == gram
        used = of_gold & same & (state.open > 0)
        return F.struct(
            gram.alias("gram"),
            (F.when(same, state.open).otherwise(F.lit(0)) + F.when(used, -1).when(of_gold, 0).otherwise(1)).alias("open"),
            (state.hits + F.when(used, 1).otherwise(0)).alias("hits"),
        )

    def made(x: Column) -> Column:
        return F.aggregate(F.sort_array(F.concat(sided(x.p, 0), sided(x.g, 1))), start, step, lambda state: state.hits)

    return apart(made, p=p, g=g)


def with_hits(df: DataFrame, kinds: dict[str, tuple[str, str, int]]) -> DataFrame:
    """``df`` with, for each kind (two columns of words and a width), the clipped overlap of its n-grams.
    Row by row in SQL expressions: nothing is shuffled, and a stream can do it as well."""
    columns = df.columns
    for p, g in dict.fromkeys((p, g) for p, g, _ in kinds.values()):
        wanted = {n: name for name, (a, b, n) in kinds.items() if (a, b) == (p, g)}
        df = df.withColumns({f"_{c}_1": F.transform(F.col(c), lambda w: F.xxhash64(w)) for c in (p, g)})
        for n in range(2, max(wanted) + 1):
            df = df.withColumns({f"_{c}_{n}": longer(f"_{c}_{n - 1}", f"_{c}_1", n) for c in (p, g)})
        df = df.withColumns({name: counted_off(f"_{p}_{n}", f"_{g}_{n}") for n, name in wanted.items()})
    return df.select(*[F.col(f"`{c}`") for c in columns], *kinds)


def prf(shared: Column, n_predicted: Column, n_gold: Column, name: str) -> list[Column]:
    """Precision, recall and F1 of an overlap."""
    zero = F.lit(0.0)
    p = F.when(n_predicted > 0, shared / n_predicted).otherwise(zero)
    r = F.when(n_gold > 0, shared / n_gold).otherwise(zero)
    f1 = F.when(shared > 0, 2 * p * r / (p + r)).otherwise(zero)
    return [value.alias(f"{name}_{part}") for value, part in zip((p, r, f1), PARTS)]


def gram_prf(shared: str, n: int, name: str) -> list[Column]:
    sizes = [F.greatest(F.size(c) - (n - 1), F.lit(0)) for c in ("rp", "rg")]
    return prf(F.col(shared), *sizes, name)


def bleu_of(names: Sequence[str], candidate: str = "bp", reference: str = "bg") -> Column:
    """Smoothed four-gram BLEU from the clipped overlaps ``names`` of 1 to 4 words and the arrays of words."""
    c, r = F.size(candidate), F.size(reference)
    logs = None
    for n, name in enumerate(names, 1):
        shared = F.when(F.col(name) == 0, F.lit(0.1)).otherwise(F.col(name))
        one = F.lit(0.25) * F.log(shared / F.greatest(c - (n - 1), F.lit(1)))
        logs = one if logs is None else logs + one
    brevity = F.when(c > r, F.lit(1.0)).otherwise(F.exp(F.lit(1.0) - r / F.greatest(c, F.lit(1))))
    return F.when(F.col(names[0]) == 0, F.lit(0.0)).otherwise(brevity * F.exp(logs))


ROUGE12 = {"r1": ("rp", "rg", 1), "r2": ("rp", "rg", 2)}
BLEU = {f"b{n}": ("bp", "bg", n) for n in (1, 2, 3, 4)}


def plus(df: DataFrame, rows: DataFrame, made: dict[str, Column]) -> DataFrame:
    """The columns of ``df`` in ``rows``, and those made."""
    return rows.select(*[F.col(f"`{c}`") for c in df.columns if c not in made], *[value.alias(name) for name, value in made.items()])


def rouge(
    df: DataFrame, predicted: str = "predicted_answer", gold: str = "gold_answer", stemmed: bool = True, grams: bool = True, lcs: bool = True
) -> DataFrame:
    """``df`` with precision, recall and F1 of ROUGE-1 and -2 (``grams``) and ROUGE-L (``lcs``).

    A row with a null text gets nulls; a text without a word scores 0.
    """
    rows, columns = with_rouge_words(df, F.col(predicted), F.col(gold), stemmed, lcs), []
    if grams:
        rows = with_hits(rows, ROUGE12)
        columns += gram_prf("r1", 1, "rouge1") + gram_prf("r2", 2, "rouge2")
    if lcs:
        columns += gram_prf("lcs", 1, "rougeL")
    known = F.col("rp").isNotNull() & F.col("rg").isNotNull()
    names = [f"rouge{x}_{part}" for x in ("12" if grams else "") + ("L" if lcs else "") for part in PARTS]
    return plus(df, rows, {name: F.when(known, c) for name, c in zip(names, columns)})


def bleu(df: DataFrame, predicted: str = "predicted_answer", gold: str = "gold_answer", name: str = "bleu") -> DataFrame:
    """``df`` with the smoothed four-gram sentence BLEU of its pairs (E13); null for a null text."""
    rows = with_hits(df.withColumns({"bp": fields(F.col(predicted)), "bg": fields(F.col(gold))}), BLEU)
    known = F.col("bp").isNotNull() & F.col("bg").isNotNull()
    return plus(df, rows, {name: F.when(known, bleu_of(list(BLEU)))})


def with_summary_score(df: DataFrame, predicted: str = "predicted_answer", gold: str = "gold_answer", name: str = "summary") -> DataFrame:
    """``df`` with the struct of :func:`lantern.functions.overlap.score_summary` for its pairs (E14-E16):
    both texts trimmed, stems for ROUGE, all but the score and the bands rounded for display."""
    rows = df.withColumns({"_sp": strip(predicted), "_sg": strip(gold)})
    rows = rows.withColumns({"bp": fields("_sp"), "bg": fields("_sg")})
    rows = with_hits(with_rouge_words(rows, F.col("_sp"), F.col("_sg"), True, True), {**ROUGE12, **BLEU})
    parts = [f"rouge{x}_{part}" for x in "12L" for part in PARTS]
    scores = [*gram_prf("r1", 1, "rouge1"), *gram_prf("r2", 2, "rouge2"), *gram_prf("lcs", 1, "rougeL")]
    rows = rows.withColumns({f"_{n}": c for n, c in zip(parts, scores)} | {"_bleu": bleu_of(list(BLEU))})
    mean = (F.col("_rouge1_f1") + F.col("_rouge2_f1") + F.col("_rougeL_f1")) / 3
    c, r = F.size("bp"), F.size("bg")
    shown = F.struct(
        mean.alias("score"),
        *[F.col(f"_rouge{x}_f1").alias(f"raw_rouge{x}") for x in "12L"],
        F.col("_bleu").alias("raw_bleu"),
        *[exact_round(f"_{n}", 4).alias(n) for n in parts],
        exact_round("_bleu", 4).alias("bleu"),
        exact_round(mean, 4).alias("average_rouge"),
        c.cast("double").alias("predicted_length"),
        r.cast("double").alias("reference_length"),
        exact_round(c / F.greatest(r, F.lit(1)), 2).alias("length_ratio"),
    )
    known = F.col("rp").isNotNull() & F.col("rg").isNotNull()
    rows = rows.withColumn("_scores", F.when(known, shown))
    return plus(df, rows, {name: score_summary(F.col("_scores"))})
