"""Queries: examples, scoring, catalogs, reports (S, P, E, A)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lantern.functions.scoring import (
    display_label,
    quality_band,
    score_choice,
    score_exact,
    similarity_percent,
)
from lantern.operators import examples, overlap
from lantern.operators.evaluate import (
    accuracy,
    compare_models,
    evaluate,
    latest_results,
    numeric_metrics,
    with_code_explanation,
    with_code_score,
    with_length_statistics,
    with_math_explanation,
    with_math_score,
)
from lantern.operators.preference import limit_splits
from lantern.plans.inputs import (
    LANGUAGES,
    LANGUAGE_NAMES,
    SQL_BUFFER_LOG,
    SQL_TEXT_PAIRS,
    buffer_log,
    choice_preds,
    language_letter,
    math_preds,
    quoted,
    split_docs,
    sql_choice_preds,
    sql_draw,
    sql_exact_round,
    sql_fields,
    sql_language_index,
    sql_letter,
    sql_math_scored,
    sql_number,
    sql_split,
    sql_strip,
    sql_words,
    table,
    text_pairs,
)
from lantern.plans.stems import sql_stems
from lantern.session import fresh_path
from lantern.sources import catalog, tables
from lantern.sources.fixed_values import (
    BASELINE_CODE,
    BASELINE_OTHER,
    BENCHMARKS,
    PREFERENCE_SETS,
    SYSTEM_PROMPTS,
)

Frame = DataFrame


# --- scoring -------------------------------------------------------------------------------------
def eval_math_accuracy(spark: SparkSession, sf_dir: str) -> Frame:
    scored = with_math_score(math_preds(spark, sf_dir)).withColumn("score", F.col("math.score"))
    return accuracy(scored, ["o_orderpriority"]).withColumn("mean_score", F.round("mean_score", 8))


SQL_MATH_ACCURACY = f"""SELECT o_orderpriority, count(*) AS rows, count(score) AS scored,
    round(avg(score), 8) AS mean_score FROM ({sql_math_scored()}) GROUP BY 1"""


def math_details(spark: SparkSession, sf_dir: str) -> Frame:
    scored = with_math_explanation(with_math_score(math_preds(spark, sf_dir)))
    return scored.select(
        "o_orderkey",
        "math.score",
        "math.metric",
        "math.method",
        "math.predicted_number",
        "math.gold_number",
        F.col("explanation.absolute_difference").alias("difference"),
        F.col("explanation.tolerance").alias("tolerance"),
        (F.substring("explanation.interpretation", 1, 1) == "✓").alias("passed"),
    )


SQL_MATH_DETAILS = f"""SELECT o_orderkey, score, 'accuracy' AS metric,
    CASE WHEN pn IS NULL OR gn IS NULL THEN 'string_match' ELSE 'numeric_match' END AS method,
    pn AS predicted_number, gn AS gold_number,
    CASE WHEN pn IS NOT NULL THEN {sql_exact_round('abs(pn - gn)', 4)} END AS difference,
    CASE WHEN pn IS NOT NULL THEN {sql_exact_round('(abs(gn) * 0.01::DOUBLE)', 4)} END AS tolerance,
    score = 1 AS passed FROM ({sql_math_scored()})"""


def choice_scored(spark: SparkSession, sf_dir: str) -> Frame:
    return choice_preds(spark, sf_dir).withColumn(
        "s", score_choice("predicted_answer", "gold_answer", "choices")
    )


def eval_choice_accuracy(spark: SparkSession, sf_dir: str) -> Frame:
    scored = choice_scored(spark, sf_dir).withColumn("score", F.col("s.score"))
    return accuracy(scored, ["lang"]).withColumn("mean_score", F.round("mean_score", 8))


SQL_CHOICE_SCORED = f"""SELECT doc_id, lang, letter, gold_answer,
    CASE WHEN letter = gold_answer THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS score
    FROM (SELECT *, {sql_letter('predicted_answer')} AS letter FROM ({sql_choice_preds()}))"""
SQL_CHOICE_ACCURACY = f"""SELECT lang, count(*) AS rows, count(score) AS scored,
    round(avg(score), 8) AS mean_score FROM ({SQL_CHOICE_SCORED}) GROUP BY 1"""


def choice_details(spark: SparkSession, sf_dir: str) -> Frame:
    return choice_scored(spark, sf_dir).select(
        "doc_id",
        "s.score",
        "s.extracted_answer",
        "s.correct_letter",
        "s.is_valid_choice",
        F.array_join("s.valid_choices", "").alias("valid_choices"),
        "s.interpretation",
    )


SQL_CHOICE_DETAILS = f"""SELECT doc_id, score, letter AS extracted_answer, gold_answer AS correct_letter,
    letter IN ('A', 'B', 'C', 'D') AS is_valid_choice, 'ABCD' AS valid_choices,
    CASE WHEN score = 1 THEN '✓ Correct answer!' ELSE '✗ Incorrect answer' END AS interpretation
    FROM ({SQL_CHOICE_SCORED})"""


def eval_exact_match(spark: SparkSession, sf_dir: str) -> Frame:
    said = F.concat(F.lit(" \t"), F.upper("lang"), F.lit("\n"))
    gold = F.when(F.col("doc_id") % 2 == 0, F.col("lang")).otherwise(F.col("source"))
    scored = table(spark, sf_dir, "documents").withColumn("score", score_exact(said, gold).score)
    return accuracy(scored, ["source"]).withColumn("mean_score", F.round("mean_score", 8))


SQL_EXACT = f"""SELECT source, count(*) AS rows, count(score) AS scored, round(avg(score), 8) AS mean_score
    FROM (SELECT source, CASE WHEN lower({sql_strip("' ' || chr(9) || upper(lang) || chr(10)")})
        = lower({sql_strip('CASE WHEN doc_id % 2 = 0 THEN lang ELSE source END')})
        THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS score FROM documents) GROUP BY 1"""

MIXED = ["mmlu", "GSM8K", "HumanEval", "my own set", "TruthfulQA", "CNNDailyMail"]


def mixed_predictions(spark: SparkSession, sf_dir: str) -> Frame:
    """Text pairs dealt out over six data sets, one of each scorer family at least, with answers that suit each."""
    way = F.col("doc_id") % len(MIXED)
    names = F.array(*[F.lit(m) for m in MIXED])
    pairs = text_pairs(spark, sf_dir)
    number = F.length("predicted_answer")
    letters = way.isin(0, 4)
    return pairs.select(
        "doc_id",
        names[way.cast("int")].alias("dataset"),
        F.when(letters, F.concat(F.lit("Answer: "), language_letter()))
        .when(way == 1, F.concat(F.lit("it is "), number.cast("string")))
        .when(way == 3, F.concat(F.upper("lang"), F.lit(" ")))
        .otherwise(F.col("predicted_answer"))
        .alias("predicted_answer"),
        F.when(letters, F.when(F.col("doc_id") % 4 == 0, F.lit("b")).otherwise(language_letter()))
        .when(way == 1, (number + F.col("doc_id") % 7).cast("string"))
        .when(way == 3, F.col("lang"))
        .otherwise(F.col("gold_answer"))
        .alias("gold_answer"),
    )


SQL_MIXED = f"""SELECT doc_id, {MIXED}[CAST(doc_id % 6 AS INT) + 1] AS dataset, doc_id % 6 AS way,
    CASE WHEN doc_id % 6 IN (0, 4) THEN 'Answer: ' || letter
        WHEN doc_id % 6 = 1 THEN 'it is ' || length(predicted_answer)
        WHEN doc_id % 6 = 3 THEN upper(lang) || ' ' ELSE predicted_answer END AS p,
    CASE WHEN doc_id % 6 IN (0, 4) THEN CASE WHEN doc_id % 4 = 0 THEN 'b' ELSE letter END
        WHEN doc_id % 6 = 1 THEN CAST(length(predicted_answer) + doc_id % 7 AS VARCHAR)
        WHEN doc_id % 6 = 3 THEN lang ELSE gold_answer END AS g
    FROM (SELECT *, chr(CAST(65 + {sql_language_index()} AS INT)) AS letter FROM ({SQL_TEXT_PAIRS}))"""


def sql_jaccard(p: str, g: str) -> str:
    a, b = f"list_distinct({sql_words(p)})", f"list_distinct({sql_words(g)})"
    return (
        f"CASE WHEN len({a}) = 0 OR len({b}) = 0 THEN 0.0::DOUBLE ELSE len(list_intersect({a}, {b}))::DOUBLE"
        f" / (len({a}) + len({b}) - len(list_intersect({a}, {b}))) END"
    )


def eval_dispatch(spark: SparkSession, sf_dir: str) -> Frame:
    scored = evaluate(mixed_predictions(spark, sf_dir))
    report = accuracy(scored, ["dataset", "metric"], totals=True)
    return report.withColumn("mean_score", F.round("mean_score", 8))


def code_scored(spark: SparkSession, sf_dir: str) -> Frame:
    return with_code_score(text_pairs(spark, sf_dir), name="s")


def code_jaccard(spark: SparkSession, sf_dir: str) -> Frame:
    return with_code_explanation(code_scored(spark, sf_dir), "s").select(
        "doc_id",
        F.round("s.similarity", 8).alias("similarity"),
        "s.score",
        "s.metric",
        "s.common_tokens",
        "s.predicted_tokens",
        "s.gold_tokens",
        "s.predicted_length",
        "s.gold_length",
        "explanation.interpretation",
    )


SQL_CODE_SETS = f"""SELECT doc_id, list_distinct({sql_words('p')}) AS a, list_distinct({sql_words('g')}) AS b,
    length(p) AS p_len, length(g) AS g_len FROM (SELECT doc_id, {sql_strip('predicted_answer')} AS p,
    {sql_strip('gold_answer')} AS g FROM ({SQL_TEXT_PAIRS}))"""
SQL_CODE_SIMILARITY = f"""SELECT *, CASE WHEN len(a) = 0 OR len(b) = 0 THEN 0.0::DOUBLE ELSE
    common::DOUBLE / (len(a) + len(b) - common) END AS similarity
    FROM (SELECT *, len(list_intersect(a, b)) AS common FROM ({SQL_CODE_SETS}))"""
SQL_CODE = f"""SELECT doc_id, round(similarity, 8) AS similarity,
    CASE WHEN similarity > 0.7 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS score, 'pass@1' AS metric,
    CAST(common AS INT) AS common_tokens, CAST(len(a) AS INT) AS predicted_tokens,
    CAST(len(b) AS INT) AS gold_tokens, CAST(p_len AS INT) AS predicted_length,
    CAST(g_len AS INT) AS gold_length,
    CASE WHEN similarity > 0.7 THEN '✓ Pass' ELSE '✗ Fail' END || ' (similarity: '
        || printf('%.1f', {sql_exact_round('(similarity * 100)', 1)}) || '%, threshold: 70%)' AS interpretation
    FROM ({SQL_CODE_SIMILARITY})"""


def score_labels(spark: SparkSession, sf_dir: str) -> Frame:
    scored = code_scored(spark, sf_dir).withColumn("f", F.col("s.similarity"))
    label = display_label("f")
    return scored.select(
        "doc_id",
        *[quality_band("f", m).alias(f"{m}_band") for m in ("rouge1", "rouge2", "rougeL", "bleu")],
        label.percent.alias("percent"),
        label.verdict.alias("verdict"),
        similarity_percent("f").alias("similarity_percent"),
    )


def sql_band(best: float, good: float) -> str:
    return (
        f"CASE WHEN similarity > {best} THEN 'Excellent' WHEN similarity > {good} THEN 'Good' "
        "ELSE 'Needs improvement' END"
    )


SQL_LABELS = f"""SELECT doc_id, {sql_band(.5, .3)} AS rouge1_band, {sql_band(.4, .2)} AS rouge2_band,
    {sql_band(.5, .3)} AS "rougeL_band", {sql_band(.5, .3)} AS bleu_band,
    CAST(CAST(round(similarity * 100) AS BIGINT) AS VARCHAR) || '%' AS percent,
    CASE WHEN similarity = 1 THEN '✓ Perfect Match!' ELSE '× Needs Review' END AS verdict,
    printf('%.1f', {sql_exact_round('(similarity * 100)', 1, 'up')}) || '%' AS similarity_percent
    FROM ({SQL_CODE_SIMILARITY})"""


def length_stats(spark: SparkSession, sf_dir: str) -> Frame:
    counted = with_length_statistics(text_pairs(spark, sf_dir), "predicted_answer", "gold_answer")
    return counted.select("doc_id", "lengths.*")


SQL_LENGTHS = f"""SELECT doc_id, CAST(p AS INT) AS predicted_length, CAST(g AS INT) AS reference_length,
    {sql_exact_round('(p::DOUBLE / greatest(g, 1))', 2)} AS length_ratio
    FROM (SELECT doc_id, len({sql_fields('predicted_answer')}) AS p, len({sql_fields('gold_answer')}) AS g
        FROM ({SQL_TEXT_PAIRS}))"""


def score_explanations(spark: SparkSession, sf_dir: str) -> Frame:
    """Scored rows per explanation text: the texts are a small table, joined after counting."""
    family = F.lit("math")
    scored = with_math_score(math_preds(spark, sf_dir)).select("math.method")
    name = F.when(F.col("method") == "numeric_match", "Numeric Match with Tolerance").otherwise("String Match")
    counted = scored.groupBy(name.alias("name")).agg(F.count(F.lit(1)).alias("rows"))
    texts = catalog.metric_texts(spark).where(F.col("family") == family)
    return counted.join(F.broadcast(texts), "name").select("name", "rows", "family", "description")


SQL_EXPLANATIONS = f"""SELECT name, count(*) AS rows, 'math' AS family, CASE name
    WHEN 'String Match' THEN 'Evaluates math answers by exact string matching when numeric extraction fails'
    ELSE 'Evaluates math answers by comparing numeric values with a small tolerance for rounding errors' END
    AS description FROM (SELECT CASE WHEN pn IS NULL OR gn IS NULL THEN 'String Match'
        ELSE 'Numeric Match with Tolerance' END AS name FROM ({sql_math_scored()})) GROUP BY 1"""


# --- overlap metrics -----------------------------------------------------------------------------
def rouge12_nostem(spark: SparkSession, sf_dir: str) -> Frame:
    return rouge_columns(overlap.rouge(text_pairs(spark, sf_dir), stemmed=False, lcs=False))


def rouge_columns(scored: Frame) -> Frame:
    names = [c for c in scored.columns if c.startswith("rouge")]
    return scored.select("doc_id", *[F.round(c, 8).alias(c) for c in names])


def sql_hits(most: int, tok: str = "tok", to: str = "n") -> str:
    """Tables n1, n2... over the words in ``tok``: clipped n-gram hits and n-gram numbers of both sides."""
    gram = "array_to_string(list_slice({t}, i, i + {k} - 1), ' ')"
    lists = " UNION ALL ".join(
        f"SELECT doc_id, {k} AS n, {side} AS side, unnest(list_transform(range(1, len({t}) - {k - 2}), "
        f"lambda i: {gram.format(t=t, k=k)})) AS gram FROM {tok}"
        for k in range(1, most + 1)
        for side, t in enumerate(("pt", "gt"))
    )
    each = ", ".join(
        f"{to}{k} AS (SELECT t.doc_id, greatest(len(pt) - {k - 1}, 0) AS np, greatest(len(gt) - {k - 1}, 0) AS ng, "
        f"coalesce(h.hits, 0) AS hits FROM {tok} t LEFT JOIN clipped_{to} h ON h.doc_id = t.doc_id AND h.n = {k})"
        for k in range(1, most + 1)
    )
    return f"""counted_{to} AS (SELECT doc_id, n, gram, count(*) FILTER (side = 0) AS p, count(*) FILTER (side = 1) AS g
        FROM ({lists}) GROUP BY ALL),
    clipped_{to} AS MATERIALIZED (SELECT doc_id, n, CAST(sum(least(p, g)) AS BIGINT) AS hits FROM counted_{to} GROUP BY ALL), {each}"""


def sql_stemmed(source: str) -> str:
    """Table ``tok`` of stemmed words over a query with ``doc_id``, ``p`` and ``g``."""
    side = (
        "SELECT doc_id, list(coalesce(stem, w) ORDER BY i) AS {t} FROM (SELECT doc_id, unnest({t}) AS w, "
        "generate_subscripts({t}, 1) AS i FROM raw) LEFT JOIN stems USING (w) GROUP BY doc_id"
    )
    return f"""raw AS MATERIALIZED (SELECT doc_id, regexp_extract_all(lower(p), '[a-z0-9]+') AS pt,
        regexp_extract_all(lower(g), '[a-z0-9]+') AS gt FROM ({source})),
    vocabulary AS MATERIALIZED (SELECT DISTINCT w FROM (SELECT unnest(pt) AS w FROM raw UNION ALL SELECT unnest(gt) FROM raw)),
    stems AS MATERIALIZED ({sql_stems('vocabulary')}),
    tok AS MATERIALIZED (SELECT raw.doc_id, coalesce(a.pt, []) AS pt, coalesce(b.gt, []) AS gt FROM raw
        LEFT JOIN ({side.format(t='pt')}) a ON a.doc_id = raw.doc_id LEFT JOIN ({side.format(t='gt')}) b ON b.doc_id = raw.doc_id)"""


def sql_prf(n: int | str, label: str = "") -> str:
    """Precision, recall and F1 from the counts of n{n}."""
    name = label or f"rouge{n}"
    p = f"CASE WHEN n{n}.np > 0 THEN n{n}.hits::DOUBLE / n{n}.np ELSE 0 END"
    r = f"CASE WHEN n{n}.ng > 0 THEN n{n}.hits::DOUBLE / n{n}.ng ELSE 0 END"
    return f"""round({p}, 8) AS "{name}_precision", round({r}, 8) AS "{name}_recall",
        round(CASE WHEN n{n}.hits > 0 THEN 2 * ({p}) * ({r}) / (({p}) + ({r})) ELSE 0 END, 8) AS "{name}_f1" """


SQL_ROUGE12 = f"""WITH tok AS MATERIALIZED (SELECT doc_id,
        regexp_extract_all(lower(predicted_answer), '[a-z0-9]+') AS pt,
        regexp_extract_all(lower(gold_answer), '[a-z0-9]+') AS gt FROM ({SQL_TEXT_PAIRS})),
    {sql_hits(2)}
    SELECT n1.doc_id, {sql_prf(1)}, {sql_prf(2)} FROM n1 JOIN n2 ON n1.doc_id = n2.doc_id"""


def rouge_lcs_nostem(spark: SparkSession, sf_dir: str) -> Frame:
    return rouge_columns(overlap.rouge(text_pairs(spark, sf_dir), stemmed=False, grams=False))


# The subsequence length row by row of the usual table, a row held as the bits of one number: the gold
# passages have fewer than 120 words, so that a row fits 128 bits. Table nl, over tok.
SQL_LCS_STEPS = """mask AS MATERIALIZED (SELECT doc_id, w, CAST(sum(1::HUGEINT << (i - 1)::INT) AS HUGEINT) AS m FROM (
        SELECT doc_id, unnest(gt) AS w, generate_subscripts(gt, 1) AS i FROM tok) GROUP BY ALL),
    hit AS MATERIALIZED (SELECT doc_id, m, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS i FROM (
        SELECT doc_id, unnest(pt) AS w, generate_subscripts(pt, 1) AS i FROM tok) JOIN mask USING (doc_id, w)),
    walk AS (SELECT doc_id, 0::BIGINT AS i, (1::HUGEINT << len(gt)::INT) - 1 AS bits, (1::HUGEINT << len(gt)::INT) - 1 AS whole
        FROM tok UNION ALL
        SELECT w.doc_id, h.i, ((w.bits + (w.bits & h.m)) | (w.bits - (w.bits & h.m))) & w.whole, w.whole
        FROM walk w JOIN hit h ON w.doc_id = h.doc_id AND h.i = w.i + 1),
    nl AS (SELECT tok.doc_id, len(pt) AS np, len(gt) AS ng, len(gt) - l.left_over AS hits FROM tok JOIN (
        SELECT doc_id, arg_max(bit_count(bits), i) AS left_over FROM walk GROUP BY 1) l ON tok.doc_id = l.doc_id)"""
SQL_LCS = f"""WITH RECURSIVE tok AS MATERIALIZED (SELECT doc_id,
        regexp_extract_all(lower(predicted_answer), '[a-z0-9]+') AS pt,
        regexp_extract_all(lower(gold_answer), '[a-z0-9]+') AS gt FROM ({SQL_TEXT_PAIRS})),
    {SQL_LCS_STEPS}
    SELECT nl.doc_id, {sql_prf('l', 'rougeL')}
    FROM nl"""


def rouge_full(spark: SparkSession, sf_dir: str) -> Frame:
    return rouge_columns(overlap.rouge(text_pairs(spark, sf_dir)))


SQL_PAIR_TEXTS = f"SELECT doc_id, predicted_answer AS p, gold_answer AS g FROM ({SQL_TEXT_PAIRS})"
SQL_ROUGE = f"""WITH RECURSIVE {sql_stemmed(SQL_PAIR_TEXTS)}, {sql_hits(2)}, {SQL_LCS_STEPS}
    SELECT n1.doc_id, {sql_prf(1)}, {sql_prf(2)}, {sql_prf('l', 'rougeL')}
    FROM n1 JOIN n2 USING (doc_id) JOIN nl USING (doc_id)"""


def bleu(spark: SparkSession, sf_dir: str) -> Frame:
    return overlap.bleu(text_pairs(spark, sf_dir)).select("doc_id", F.round("bleu", 8).alias("bleu"))


def sql_bleu(to: str) -> str:
    """BLEU from the tables {to}1 to {to}4."""
    logs = [
        f"0.25 * ln(CASE WHEN {to}{n}.hits = 0 THEN 0.1::DOUBLE ELSE {to}{n}.hits::DOUBLE END / greatest({to}{n}.np, 1))"
        for n in (1, 2, 3, 4)
    ]
    return f"""CASE WHEN {to}1.hits = 0 THEN 0.0::DOUBLE ELSE CASE WHEN {to}1.np > {to}1.ng THEN 1.0::DOUBLE
        ELSE exp(1 - {to}1.ng::DOUBLE / {to}1.np) END * exp({' + '.join(logs)}) END"""


SQL_BLEU = f"""WITH tok AS MATERIALIZED (SELECT doc_id, {sql_fields('predicted_answer')} AS pt,
        {sql_fields('gold_answer')} AS gt FROM ({SQL_TEXT_PAIRS})),
    {sql_hits(4)}
    SELECT n1.doc_id, round({sql_bleu('n')}, 8) AS bleu
    FROM n1 JOIN n2 USING (doc_id) JOIN n3 USING (doc_id) JOIN n4 USING (doc_id)"""


def sql_f1(name: str) -> str:
    """F1 in the steps of the operator: 2PR / (P + R)."""
    p, r = f"({name}.hits::DOUBLE / {name}.np)", f"({name}.hits::DOUBLE / {name}.ng)"
    return f"CASE WHEN {name}.hits > 0 THEN 2 * {p} * {r} / ({p} + {r}) ELSE 0.0::DOUBLE END"


def sql_summaries(source: str) -> str:
    """Unrounded F1 values, BLEU, their mean and word numbers of trimmed pairs (``doc_id``, ``p``, ``g``)."""
    trimmed = f"SELECT doc_id, {sql_strip('p')} AS p, {sql_strip('g')} AS g FROM ({source})"
    return f"""WITH RECURSIVE {sql_stemmed(trimmed)}, {sql_hits(2)}, {SQL_LCS_STEPS},
        spaced AS MATERIALIZED (SELECT doc_id, {sql_fields('p')} AS pt, {sql_fields('g')} AS gt FROM ({trimmed})),
        {sql_hits(4, 'spaced', 'b')}
    SELECT *, (f1 + f2 + fl) / 3 AS score FROM (SELECT n1.doc_id, {sql_f1('n1')} AS f1, {sql_f1('n2')} AS f2,
        {sql_f1('nl')} AS fl, {sql_bleu('b')} AS bleu, b1.np AS np, b1.ng AS ng FROM n1 JOIN n2 USING (doc_id)
        JOIN nl USING (doc_id) JOIN b1 USING (doc_id) JOIN b2 USING (doc_id) JOIN b3 USING (doc_id) JOIN b4 USING (doc_id))"""


def eval_summary(spark: SparkSession, sf_dir: str) -> Frame:
    """All pairs as summaries: mean ROUGE, bands and lengths through the one scorer entry."""
    scored = evaluate(text_pairs(spark, sf_dir).withColumn("dataset", F.lit("CNNDailyMail")))
    d = "details.summary"
    return scored.select(
        "doc_id",
        F.round("score", 8).alias("score"),
        "metric",
        *[
            f"{d}.{c}"
            for c in ("rouge1_f1", "rouge2_f1", "rougeL_f1", "bleu", "average_rouge", "rouge1_band", "length_ratio")
        ],
    )


SQL_SUMMARY = f"""SELECT doc_id, round(score, 8) AS score, 'ROUGE-Avg' AS metric, {sql_exact_round('f1', 4)} AS rouge1_f1,
    {sql_exact_round('f2', 4)} AS rouge2_f1, {sql_exact_round('fl', 4)} AS "rougeL_f1", {sql_exact_round('bleu', 4)} AS bleu,
    {sql_exact_round('score', 4)} AS average_rouge, CASE WHEN f1 > 0.5 THEN 'Excellent' WHEN f1 > 0.3 THEN 'Good'
        ELSE 'Needs improvement' END AS rouge1_band,
    {sql_exact_round('(np::DOUBLE / greatest(ng, 1))', 2)} AS length_ratio FROM ({sql_summaries(SQL_PAIR_TEXTS)})"""


SQL_MIXED_SUMMARIES = sql_summaries(f"SELECT doc_id, p, g FROM ({SQL_MIXED}) WHERE way = 5")
SQL_MIXED_SCORED = f"""SELECT doc_id, dataset,
    CASE way WHEN 2 THEN 'pass@1' WHEN 3 THEN 'exact_match' WHEN 5 THEN 'ROUGE-Avg' ELSE 'accuracy' END AS metric,
    CASE WHEN way = 5 THEN summaries.score ELSE CAST(CASE WHEN way IN (0, 4) THEN CASE WHEN {sql_letter('p')} = upper({sql_strip('g')}) THEN 1 ELSE 0 END
        WHEN way = 1 THEN CASE WHEN abs({sql_number('p')} - {sql_number('g')})
            <= abs({sql_number('g')}) * 0.01::DOUBLE THEN 1 ELSE 0 END
        WHEN way = 2 THEN CASE WHEN {sql_jaccard(sql_strip('p'), sql_strip('g'))} > 0.7 THEN 1 ELSE 0 END
        ELSE CASE WHEN lower({sql_strip('p')}) = lower({sql_strip('g')}) THEN 1 ELSE 0 END END AS DOUBLE) END
        AS score FROM ({SQL_MIXED}) m LEFT JOIN ({SQL_MIXED_SUMMARIES}) summaries USING (doc_id)"""
SQL_DISPATCH = f"""SELECT dataset, metric, count(*) AS rows, count(score) AS scored,
    round(avg(score), 8) AS mean_score FROM ({SQL_MIXED_SCORED}) GROUP BY ROLLUP (dataset, metric)"""


# --- examples ------------------------------------------------------------------------------------
def raw_benchmark(spark: SparkSession, sf_dir: str, dataset: str) -> Frame:
    """Raw benchmark rows, in the schema each builder expects, made from the tables."""
    docs = table(spark, sf_dir, "documents")
    names = F.array(*[F.lit(x) for x in LANGUAGE_NAMES])
    at = F.array_position(F.array(*[F.lit(x) for x in LANGUAGES]), F.col("lang")).cast("int") - 1
    if dataset == "MMLU":
        subject = F.when(F.col("source") != "src0", F.col("source"))
        return docs.select(
            F.col("doc_id").alias("id"),
            F.col("text").alias("question"),
            names.alias("choices"),
            at.alias("answer"),
            subject.alias("subject"),
        )
    if dataset == "GSM8K":
        gold = F.col("o_totalprice").cast("decimal(18,2)").cast("string")
        return table(spark, sf_dir, "orders").select(
            F.col("o_orderkey").alias("id"),
            F.concat(F.lit("What is the price of order "), F.col("o_orderkey").cast("string"), F.lit("?")).alias("question"),
            F.concat(F.lit("look it up #### 0 "), F.col("o_orderpriority"), F.lit("\n#### "), gold, F.lit(" \n")).alias("answer"),
        )
    if dataset == "HumanEval":
        return table(spark, sf_dir, "benchmark").select(
            F.col("item_id").alias("id"),
            F.concat(F.lit("task/"), F.col("item_id").cast("string")).alias("task_id"),
            F.col("text").alias("prompt"),
            F.reverse("text").alias("canonical_solution"),
            F.md5("text").alias("test"),
            F.concat(F.lit("f"), F.col("item_id").cast("string")).alias("entry_point"),
        )
    if dataset == "HellaSwag":
        endings = F.array(*[F.lit(x) for x in ("plain", "good", "toxic", "good and toxic")])
        return docs.join(table(spark, sf_dir, "labels"), "doc_id").select(
            F.col("doc_id").alias("id"),
            F.col("text").alias("ctx"),
            endings.alias("endings"),
            (F.col("quality") + 2 * F.col("toxic")).cast("string").alias("label"),
            F.col("lang").alias("activity_label"),
        )
    if dataset == "TruthfulQA":
        three = F.array(*[F.lit(x) for x in LANGUAGE_NAMES[:3]])
        hits = F.array(*[(F.col("lang") == x).cast("int") for x in LANGUAGES[:3]])
        return docs.select(
            F.col("doc_id").alias("id"),
            F.col("text").alias("question"),
            F.struct(three.alias("choices"), hits.alias("labels")).alias("mc1_targets"),
            F.col("source").alias("category"),
        )
    if dataset == "GPQA":
        right = names[at]
        wrong = F.filter(names, lambda n: n != right)
        return docs.select(
            F.col("doc_id").alias("id"),
            F.col("text").alias("Question"),
            right.alias("Correct Answer"),
            *[wrong[i].alias(f"Incorrect Answer {i + 1}") for i in range(3)],
            F.col("source").alias("Subdomain"),
        )
    if dataset == "CNNDailyMail":
        pairs = text_pairs(spark, sf_dir).select("doc_id", "gold_answer")
        return docs.join(pairs, "doc_id").select(
            F.col("doc_id").alias("id"), F.col("text").alias("article"), F.col("gold_answer").alias("highlights")
        )
    raise ValueError(dataset)


def flat_examples(df: Frame) -> Frame:
    """Example rows with choices and metadata as text, so that any engine can compare them."""
    pairs = F.transform(
        F.array_sort(F.map_entries("metadata")), lambda e: F.concat(e.key, F.lit("="), e.value)
    )
    return df.select(
        "id",
        "dataset",
        "prompt",
        "gold_answer",
        F.array_join("choices", "|").alias("choices"),
        F.array_join(pairs, "|").alias("metadata"),
    )


def example_query(dataset: str):
    def run(spark: SparkSession, sf_dir: str) -> Frame:
        return flat_examples(examples.build(dataset, raw_benchmark(spark, sf_dir, dataset), ["id"]))

    return run


def sql_lettered(header: str, text: str, choices: str) -> str:
    lines = f"list_transform({choices}, lambda c, i: chr(CAST(64 + i AS INT)) || '. ' || c || chr(10))"
    return f"'{header}' || {text} || chr(10) || chr(10) || array_to_string({lines}, '') || chr(10) || 'Answer:'"


def sql_example(dataset: str, source: str, prompt: str, gold: str, choices: str, notes: str, key: str) -> str:
    return f"""SELECT {key} AS id, '{dataset}' AS dataset, {prompt} AS prompt, {gold} AS gold_answer,
        {choices} AS choices, {notes} AS metadata FROM {source}"""


SQL_NAMES = "['English', 'German', 'French', 'Spanish']"
SQL_GPQA_SOURCE = f"""(SELECT *, list_transform(list_sort([{', '.join(
    f"{{'at': {sql_draw('doc_id', str(i))}, 'text': {text}}}"
    for i, text in enumerate(['wrong[1]', 'wrong[2]', 'wrong[3]', 'answer_name'])
)}]), lambda z: z.text) AS dealt FROM (SELECT *, list_filter({SQL_NAMES}, lambda n: n <> answer_name) AS wrong
    FROM (SELECT *, {SQL_NAMES}[CAST({sql_language_index()} + 1 AS INT)] AS answer_name FROM documents)))"""
SQL_GOLD_PRICE = "CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR)"
SQL_HELLA = "['plain', 'good', 'toxic', 'good and toxic']"
SQL_EXAMPLES = {
    "MMLU": sql_example(
        "MMLU",
        "documents",
        sql_lettered("Question: ", "text", SQL_NAMES),
        f"chr(CAST(65 + {sql_language_index()} AS INT))",
        "'English|German|French|Spanish'",
        "'subject=' || CASE WHEN source <> 'src0' THEN source ELSE 'unknown' END",
        "doc_id",
    ),
    "GSM8K": sql_example(
        "GSM8K",
        "orders",
        "'Question: What is the price of order ' || o_orderkey || '?' || chr(10) || chr(10) || "
        "'Provide your answer as a number.'",
        SQL_GOLD_PRICE,
        "CAST(NULL AS VARCHAR)",
        "'full_solution=look it up #### 0 ' || o_orderpriority || chr(10) || '#### ' || "
        f"{SQL_GOLD_PRICE} || ' ' || chr(10)",
        "o_orderkey",
    ),
    "HumanEval": sql_example(
        "HumanEval",
        "benchmark",
        "text",
        "reverse(text)",
        "CAST(NULL AS VARCHAR)",
        "'entry_point=f' || item_id || '|task_id=task/' || item_id || '|test=' || md5(text)",
        "item_id",
    ),
    "HellaSwag": sql_example(
        "HellaSwag",
        "documents JOIN labels USING (doc_id)",
        sql_lettered("Context: ", "text", SQL_HELLA),
        "chr(CAST(65 + quality + 2 * toxic AS INT))",
        "'plain|good|toxic|good and toxic'",
        "'activity_label=' || lang",
        "doc_id",
    ),
    "TruthfulQA": sql_example(
        "TruthfulQA",
        "documents",
        sql_lettered("Question: ", "text", "['English', 'German', 'French']"),
        "CASE lang WHEN 'de' THEN 'B' WHEN 'fr' THEN 'C' ELSE 'A' END",
        "'English|German|French'",
        "'category=' || source",
        "doc_id",
    ),
    "GPQA": sql_example(
        "GPQA",
        SQL_GPQA_SOURCE,
        sql_lettered("Question: ", "text", "dealt"),
        "chr(CAST(64 + list_position(dealt, answer_name) AS INT))",
        "array_to_string(dealt, '|')",
        "'subdomain=' || source",
        "doc_id",
    ),
    "CNNDailyMail": sql_example(
        "CNNDailyMail",
        f"documents JOIN (SELECT doc_id, gold_answer FROM ({SQL_TEXT_PAIRS})) USING (doc_id)",
        "'Article: ' || CASE WHEN length(text) > 3000 THEN substr(text, 1, 3000) || '...' ELSE text END "
        "|| chr(10) || chr(10) || 'Provide a concise summary (2-4 sentences):'",
        "gold_answer",
        "CAST(NULL AS VARCHAR)",
        "'article_length=' || length(text) || '|summary_length=' || length(gold_answer)",
        "doc_id",
    ),
}


def benchmark_prefix(spark: SparkSession, sf_dir: str) -> Frame:
    """The rows held of three benchmarks: the first 100, the first 200, and all."""
    held = [
        examples.leading_rows(name, raw_benchmark(spark, sf_dir, name), "id").select(
            F.lit(name).alias("dataset"), "id"
        )
        for name in ("MMLU", "CNNDailyMail", "HumanEval")
    ]
    return held[0].unionByName(held[1]).unionByName(held[2])


SQL_PREFIX = """SELECT 'MMLU' AS dataset, doc_id AS id FROM (SELECT doc_id FROM documents ORDER BY doc_id LIMIT 100)
    UNION ALL SELECT 'CNNDailyMail', doc_id FROM (SELECT doc_id FROM documents ORDER BY doc_id LIMIT 200)
    UNION ALL SELECT 'HumanEval', item_id FROM benchmark"""


def all_examples(spark: SparkSession, sf_dir: str) -> Frame:
    """The seven benchmarks as one table."""
    made = [
        examples.build(name, raw_benchmark(spark, sf_dir, name), ["id"]) for name in examples.BUILDERS
    ]
    out = made[0]
    for df in made[1:]:
        out = out.unionByName(df)
    return out


def sample_examples(spark: SparkSession, sf_dir: str) -> Frame:
    return examples.sample(
        all_examples(spark, sf_dir).select("dataset", "id", "gold_answer"), "id", n=3, per=["dataset"]
    )


SQL_SAMPLE = f"""SELECT dataset, id, gold_answer FROM ({' UNION ALL '.join(
    f"SELECT dataset, id, gold_answer FROM ({q})" for q in SQL_EXAMPLES.values())})
    QUALIFY row_number() OVER (PARTITION BY dataset ORDER BY {sql_draw('id')}, id) <= 3"""


def full_prompt(spark: SparkSession, sf_dir: str) -> Frame:
    made = examples.build("HellaSwag", raw_benchmark(spark, sf_dir, "HellaSwag"), ["id"])
    system = F.when(F.col("id") % 2 == 0, F.col("system_prompt")).otherwise(F.lit(""))
    return made.select("id", examples.full_prompt("prompt", system).alias("full_prompt"))


SQL_FULL_PROMPT = f"""SELECT id, CASE WHEN id % 2 = 0 THEN {quoted(SYSTEM_PROMPTS['HellaSwag'])} || chr(10)
    || chr(10) ELSE '' END || prompt AS full_prompt FROM ({SQL_EXAMPLES['HellaSwag']})"""


def prompt_kind(spark: SparkSession, sf_dir: str) -> Frame:
    text = F.col("text")
    prompt = (
        F.when(F.col("lang") == "fr", F.concat(text, F.lit(" A. oui B. non")))
        .when(F.col("lang") == "de", F.concat(F.lit("Calculate "), text))
        .when(F.col("lang") == "es", F.concat(F.lit("def f(x): "), text))
        .otherwise(text)
    )
    docs = table(spark, sf_dir, "documents").select("doc_id", prompt.alias("prompt"))
    return docs.select(
        "doc_id",
        examples.prompt_kind("prompt").alias("kind"),
        examples.baseline_answer("prompt", "doc_id").alias("answer"),
    )


def sql_any(text: str, marks: list[str]) -> str:
    return "(" + " OR ".join(f"contains({text}, '{m}')" for m in marks) + ")"


SQL_KIND = f"""SELECT doc_id, kind, CASE kind
        WHEN 'multiple_choice' THEN chr(CAST(65 + {sql_draw('doc_id')} % 4 AS INT))
        WHEN 'math' THEN CAST({sql_draw('doc_id')} % 100 + 1 AS VARCHAR)
        WHEN 'code' THEN {quoted(BASELINE_CODE)} ELSE {quoted(BASELINE_OTHER)} END AS answer
    FROM (SELECT doc_id, CASE WHEN {sql_any('p', [' A.', ' B.', ' C.', ' D.'])} THEN 'multiple_choice'
        WHEN {sql_any('lower(p)', ['calculate', 'math', 'number', 'what is'])} THEN 'math'
        WHEN {sql_any('lower(p)', ['def ', 'function', 'return', 'code'])} THEN 'code' ELSE 'other' END AS kind
    FROM (SELECT doc_id, CASE lang WHEN 'fr' THEN text || ' A. oui B. non' WHEN 'de' THEN 'Calculate ' || text
        WHEN 'es' THEN 'def f(x): ' || text ELSE text END AS p FROM documents))"""


# --- catalogs and tables -------------------------------------------------------------------------
def catalog_list(spark: SparkSession, sf_dir: str) -> Frame:
    counted = mixed_predictions(spark, sf_dir).groupBy("dataset").agg(F.count(F.lit(1)).alias("rows"))
    return catalog.with_benchmark(counted)


def sql_values(rows: list[tuple], columns: str) -> str:
    def one(v: object) -> str:
        return "NULL" if v is None else quoted(str(v))

    return f"(VALUES {', '.join('(' + ', '.join(one(v) for v in r) + ')' for r in rows)}) AS v({columns})"


SQL_BENCHMARKS = sql_values(
    [(*row, SYSTEM_PROMPTS[row[0]]) for row in BENCHMARKS], "name, description, task_type, system_prompt"
)
SQL_CATALOG = f"""SELECT m.dataset, m.rows, v.description, v.task_type, v.system_prompt
    FROM (SELECT dataset, count(*) AS rows FROM ({SQL_MIXED}) GROUP BY 1) m
    LEFT JOIN {SQL_BENCHMARKS} ON upper(m.dataset) = upper(v.name)"""


def pref_catalog(spark: SparkSession, sf_dir: str) -> Frame:
    """Documents filed under the six preference sets, counted per set."""
    aliases = F.array(*[F.lit(r[0]) for r in PREFERENCE_SETS])
    filed = table(spark, sf_dir, "documents").select(
        aliases[(F.col("doc_id") % len(PREFERENCE_SETS)).cast("int")].alias("alias")
    )
    counted = filed.groupBy("alias").agg(F.count(F.lit(1)).alias("rows"))
    sets = catalog.preference_sets(spark).withColumn("columns", F.array_join("columns", ","))
    return sets.join(counted, "alias", "left")


SQL_PREF_CATALOG = f"""SELECT v.*, c.rows FROM {sql_values(
    [(a, s, t, d, ','.join(c), z, x, y) for a, s, t, d, c, z, x, y in PREFERENCE_SETS],
    'alias, source, type, description, columns, size, train_split, test_split')}
    LEFT JOIN (SELECT {[r[0] for r in PREFERENCE_SETS]}[CAST(doc_id % 6 AS INT) + 1] AS alias, count(*) AS rows
        FROM documents GROUP BY 1) c ON v.alias = c.alias"""


def split_report(spark: SparkSession, sf_dir: str) -> Frame:
    return catalog.split_report(split_docs(spark, sf_dir))


SQL_SPLIT_REPORT = f"""SELECT {sql_split()} AS split, count(*) AS rows,
    'doc_id, text, lang, source, n_chars' AS columns FROM documents GROUP BY 1"""


def split_limit(spark: SparkSession, sf_dir: str) -> Frame:
    limited = limit_splits(split_docs(spark, sf_dir), "doc_id", max_train=300, max_test=None)
    return limited.select("split", "doc_id", "text")


SQL_SPLIT_LIMIT = f"""SELECT split, doc_id, text FROM (SELECT *, {sql_split()} AS split FROM documents)
    QUALIFY split = 'test' OR row_number() OVER (PARTITION BY split ORDER BY doc_id) <= 300"""


def load_alias(spark: SparkSession, sf_dir: str) -> Frame:
    """Saved under its source name, loaded by its alias; the catalog knows the split names."""
    base = fresh_path(spark, "sets")
    docs = split_docs(spark, sf_dir, "train_prefs", "test_prefs")
    tables.save_dataset(docs, base, "HuggingFaceH4/ultrafeedback_binarized")
    loaded = tables.load_preferences(spark, base, "ultrafeedback-binarized")
    role = F.when(F.col("split") == loaded.train, "train").otherwise("eval")
    return loaded.data.groupBy("split", role.alias("role")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum("n_chars").alias("chars")
    )


SQL_LOAD_ALIAS = f"""SELECT split, CASE split WHEN 'train_prefs' THEN 'train' ELSE 'eval' END AS role,
    count(*) AS rows, CAST(sum(n_chars) AS BIGINT) AS chars
    FROM (SELECT *, {sql_split('train_prefs', 'test_prefs')} AS split FROM documents) GROUP BY 1, 2"""


def save_roundtrip(spark: SparkSession, sf_dir: str) -> Frame:
    base = fresh_path(spark, "sets")
    path = tables.save_dataset(split_docs(spark, sf_dir), base, "my/own set")
    return spark.read.parquet(path).select("split", "doc_id", "lang", "text")


SQL_SAVE = f"SELECT {sql_split()} AS split, doc_id, lang, text FROM documents"


# --- reports -------------------------------------------------------------------------------------
def model_scores(spark: SparkSession, sf_dir: str) -> Frame:
    """Three models: the same questions with other ways to answer."""
    scored = [
        with_math_score(math_preds(spark, sf_dir, m)).select(
            "o_orderkey",
            F.col("o_orderpriority").alias("dataset"),
            F.lit(f"m{m}").alias("model"),
            "math.score",
        )
        for m in range(3)
    ]
    return scored[0].unionByName(scored[1]).unionByName(scored[2])


SQL_MODELS = " UNION ALL ".join(
    f"SELECT o_orderkey, o_orderpriority AS dataset, 'm{m}' AS model, score FROM ({sql_math_scored(m)})"
    for m in range(3)
)


def compare(spark: SparkSession, sf_dir: str) -> Frame:
    wide = compare_models(model_scores(spark, sf_dir), ["m0", "m1", "m2"])
    return wide.select("dataset", *[F.round(m, 8).alias(m) for m in ("m0", "m1", "m2")], "best_model", F.array_join("ranking", ",").alias("ranking"))


SQL_COMPARE = f"""SELECT dataset, round(m0, 8) AS m0, round(m1, 8) AS m1, round(m2, 8) AS m2,
    CASE WHEN m0 >= m1 AND m0 >= m2 THEN 'm0' WHEN m1 >= m2 THEN 'm1' ELSE 'm2' END AS best_model,
    array_to_string(list_transform(list_sort([(-m0, 'm0'), (-m1, 'm1'), (-m2, 'm2')]), lambda z: z[2]), ',') AS ranking
    FROM (SELECT dataset, avg(score) FILTER (model = 'm0') AS m0, avg(score) FILTER (model = 'm1') AS m1,
        avg(score) FILTER (model = 'm2') AS m2 FROM ({SQL_MODELS}) GROUP BY 1)"""


def history_latest(spark: SparkSession, sf_dir: str) -> Frame:
    """Three runs appended to a history; the second and third scored other ways of answering."""
    path = fresh_path(spark, "history")
    scores = model_scores(spark, sf_dir)
    for run, model in (("r1", "m0"), ("r2", "m1"), ("r3", "m2")):
        part = scores.where(F.col("model") == model)
        # the last run covers urgent orders alone
        tables.append_history(part if run != "r3" else part.where("dataset = '1-URGENT'"), path, run)
    history = spark.read.parquet(path)
    return latest_results(history, ["o_orderkey"], [F.col("run").desc()]).select(
        "o_orderkey", "dataset", "run", "score"
    )


SQL_HISTORY = f"""SELECT o_orderkey, dataset, CASE model WHEN 'm1' THEN 'r2' ELSE 'r3' END AS run, score
    FROM ({SQL_MODELS}) WHERE model = CASE WHEN dataset = '1-URGENT' THEN 'm2' ELSE 'm1' END"""


def export_roundtrip(spark: SparkSession, sf_dir: str) -> Frame:
    """Scored rows, texts and all, through CSV and through JSON."""
    scored = evaluate(mixed_predictions(spark, sf_dir)).withColumn("score", F.round("score", 8)).select(
        "doc_id", "dataset", "predicted_answer", "metric", "score"
    )
    schema = "doc_id bigint, dataset string, predicted_answer string, metric string, score double"
    csv = tables.export(scored, fresh_path(spark, "csv"), "csv")
    json = tables.export(scored, fresh_path(spark, "json"), "json")
    back = tables.read_csv(spark, csv, schema).withColumn("kind", F.lit("csv"))
    return back.unionByName(spark.read.json(json, schema=schema).withColumn("kind", F.lit("json")))


SQL_EXPORT = f"""SELECT s.doc_id, s.dataset, m.p AS predicted_answer, s.metric, round(s.score, 8) AS score, k.kind
    FROM ({SQL_MIXED_SCORED}) s JOIN ({SQL_MIXED}) m USING (doc_id), (VALUES ('csv'), ('json')) AS k(kind)"""


def custom_dataset(spark: SparkSession, sf_dir: str) -> Frame:
    """The caller's own table with the Example columns: is a reply the talk's last word? (A5)"""
    talks = table(spark, sf_dir, "conversations")
    last = talks.groupBy("conv_id").agg(F.max_by("text", "turn").alias("gold_answer"))
    own = talks.join(last, "conv_id").select(
        F.lit("talks").alias("dataset"), "role", F.concat(F.lit("  "), F.col("text"), F.lit("\n")).alias("predicted_answer"), "gold_answer"
    )
    return accuracy(evaluate(own, summaries=False), ["role", "metric"]).withColumn(
        "mean_score", F.round("mean_score", 8)
    )


SQL_CUSTOM = f"""SELECT role, 'exact_match' AS metric, count(*) AS rows, count(score) AS scored,
    round(avg(score), 8) AS mean_score FROM (SELECT role, CASE WHEN lower({sql_strip('text')}) = lower({sql_strip('g')})
        THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS score
    FROM conversations JOIN (SELECT conv_id, arg_max(text, turn) AS g FROM conversations GROUP BY 1) USING (conv_id))
    GROUP BY 1, 2"""


def metrics_table(spark: SparkSession, sf_dir: str) -> Frame:
    """Metrics of two runs appended to a table and read back, numbers only."""
    path = fresh_path(spark, "metrics")
    log = buffer_log(spark, sf_dir)
    means = log.groupBy(F.col("event_type").alias("key")).agg(F.avg("value").cast("string").alias("value"))
    days = log.groupBy(F.concat(F.lit("day"), F.col("iteration").cast("string")).alias("key")).agg(
        F.max("event_type").alias("value")
    )
    tables.append_metrics(means.withColumn("run", F.lit("first")), path)
    tables.append_metrics(days.unionByName(means).withColumn("run", F.lit("second")), path)
    return numeric_metrics(spark.read.parquet(path)).select(
        "run", "key", F.col("value").cast("double").alias("value")
    )


SQL_METRICS = f"""SELECT r.run, event_type AS key, round(avg(value), 4) AS value
    FROM ({SQL_BUFFER_LOG}), (VALUES ('first'), ('second')) AS r(run) GROUP BY 1, 2"""

QUERIES = {
    "eval_math_accuracy": (eval_math_accuracy, SQL_MATH_ACCURACY),
    "math_details": (math_details, SQL_MATH_DETAILS),
    "eval_choice_accuracy": (eval_choice_accuracy, SQL_CHOICE_ACCURACY),
    "choice_details": (choice_details, SQL_CHOICE_DETAILS),
    "eval_exact_match": (eval_exact_match, SQL_EXACT),
    "eval_dispatch": (eval_dispatch, SQL_DISPATCH),
    "code_jaccard": (code_jaccard, SQL_CODE),
    "score_labels": (score_labels, SQL_LABELS),
    "length_stats": (length_stats, SQL_LENGTHS),
    "score_explanations": (score_explanations, SQL_EXPLANATIONS),
    "rouge12_nostem": (rouge12_nostem, SQL_ROUGE12),
    "rouge_lcs_nostem": (rouge_lcs_nostem, SQL_LCS),
    "rouge_full": (rouge_full, SQL_ROUGE),
    "bleu": (bleu, SQL_BLEU),
    "eval_summary": (eval_summary, SQL_SUMMARY),
    **{
        f"example_{name.lower()}": (example_query(name), SQL_EXAMPLES[name])
        for name in examples.BUILDERS
    },
    "benchmark_prefix": (benchmark_prefix, SQL_PREFIX),
    "sample_examples": (sample_examples, SQL_SAMPLE),
    "full_prompt": (full_prompt, SQL_FULL_PROMPT),
    "prompt_kind": (prompt_kind, SQL_KIND),
    "catalog_list": (catalog_list, SQL_CATALOG),
    "pref_catalog": (pref_catalog, SQL_PREF_CATALOG),
    "split_report": (split_report, SQL_SPLIT_REPORT),
    "split_limit": (split_limit, SQL_SPLIT_LIMIT),
    "load_alias": (load_alias, SQL_LOAD_ALIAS),
    "save_roundtrip": (save_roundtrip, SQL_SAVE),
    "compare_models": (compare, SQL_COMPARE),
    "history_latest": (history_latest, SQL_HISTORY),
    "export_roundtrip": (export_roundtrip, SQL_EXPORT),
    "custom_dataset": (custom_dataset, SQL_CUSTOM),
    "metrics_table": (metrics_table, SQL_METRICS),
}
