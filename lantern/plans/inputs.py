"""Inputs derived from the test tables, each in Spark and in SQL, row for row the same.

The tables hold no predictions, preference pairs or token streams; these recipes make them from the
columns there are. Every recipe covers all rows of its tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lantern.functions.text import SPACE_CLASS, WHITE_SPACE, WORD
from lantern.operators.ranking import joined_text
from lantern.operators.skew import spread
from lantern.sources.fixed_values import ASSISTANT_MARKER, HUMAN_MARKER

LANGUAGES = ["en", "de", "fr", "es"]
LANGUAGE_NAMES = ["English", "German", "French", "Spanish"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dealt(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table for work that is heavy on the processor, spread over all cores if it is a small one."""
    return spread(table(spark, sf_dir, name))


# --- small SQL helpers ---------------------------------------------------------------------------
def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def sql_strip(x: str) -> str:
    return f"trim({x}, {quoted(WHITE_SPACE)})"


def sql_words(x: str) -> str:
    return f"regexp_extract_all(lower({x}), '{WORD}')"


def sql_fields(x: str) -> str:
    return f"regexp_extract_all({x}, '[^{SPACE_CLASS}]+')"


def sql_draw(*parts: str) -> str:
    text = " || ':' || ".join(["'42'", *[f"CAST({p} AS VARCHAR)" for p in parts]])
    return f"CAST('0x' || substr(md5({text}), 1, 15) AS BIGINT)"


def sql_exact_round(x: str, digits: int, ties: str = "even") -> str:
    """The rounding of functions.numbers, written out for the other engine."""
    scale = f"CAST({10**digits} AS DOUBLE)"
    high = f"(abs({x}) * 134217729.0::DOUBLE - (abs({x}) * 134217729.0::DOUBLE - abs({x})))"
    whole = f"floor(abs({x}) * {scale})"
    above = f"(({high} * {scale} - {whole} - 0.5::DOUBLE) + (abs({x}) - {high}) * {scale})"
    up = (
        f"{above} >= 0"
        if ties == "up"
        else f"({above} > 0 OR ({above} = 0 AND CAST({whole} AS BIGINT) % 2 = 1))"
    )
    rounded = f"sign({x}) * ({whole} + CASE WHEN {up} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) / {scale}"
    return f"(CASE WHEN abs({x}) * {scale} >= {float(1 << 53)!r}::DOUBLE THEN {x} ELSE {rounded} END)"


# --- answers to numeric questions ----------------------------------------------------------------
def math_preds(spark: SparkSession, sf_dir: str, offset: int = 0) -> DataFrame:
    """Orders: the price as gold, and as prediction six ways of writing it, by order number."""
    gold = F.col("o_totalprice").cast("decimal(18,2)")
    way = (F.col("o_orderkey") + offset) % 6
    return dealt(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_orderpriority",
        gold.cast("string").alias("gold_answer"),
        F.when(way == 0, F.concat(F.lit("The total is "), gold.cast("string")))
        .when(way == 1, (gold * F.lit("1.005").cast("decimal(4,3)")).cast("string"))
        .when(way == 2, (gold * F.lit("1.05").cast("decimal(3,2)")).cast("string"))
        .when(way == 3, F.concat(F.lit("Answer: $"), F.format_number("o_totalprice", 2)))
        .when(way == 4, F.concat(F.lit("so \\boxed{"), gold.cast("string"), F.lit("} 7")))
        .otherwise(F.lit("no idea"))
        .alias("predicted_answer"),
    )


def sql_math_preds(offset: int = 0) -> str:
    gold = "CAST(o_totalprice AS DECIMAL(18,2))"
    return f"""SELECT o_orderkey, o_orderpriority, CAST({gold} AS VARCHAR) AS gold_answer,
        CASE (o_orderkey + {offset}) % 6
            WHEN 0 THEN 'The total is ' || CAST({gold} AS VARCHAR)
            WHEN 1 THEN CAST({gold} * CAST('1.005' AS DECIMAL(4,3)) AS VARCHAR)
            WHEN 2 THEN CAST({gold} * CAST('1.05' AS DECIMAL(3,2)) AS VARCHAR)
            WHEN 3 THEN 'Answer: $' || format('{{:,.2f}}', o_totalprice)
            WHEN 4 THEN 'so \\boxed{{' || CAST({gold} AS VARCHAR) || '}} 7'
            ELSE 'no idea' END AS predicted_answer
    FROM orders"""


# --- answers to multiple choice ------------------------------------------------------------------
def language_letter(c: Column | str = "lang", shift: Column | int = 0) -> Column:
    at = F.array_position(F.array(*[F.lit(x) for x in LANGUAGES]), F.col("lang")).cast("int") - 1
    return F.char(F.lit(65) + (at + shift) % 4)


def sql_language_index() -> str:
    return "(list_position(['en','de','fr','es'], lang) - 1)"


def choice_preds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents: the letter of the language as gold; eight ways to write it or the next letter."""
    said = F.when(F.col("doc_id") % 3 == 0, language_letter(shift=1)).otherwise(language_letter())
    way = F.col("doc_id") % 8
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        "lang",
        language_letter().alias("gold_answer"),
        F.array(*[F.lit(x) for x in LANGUAGE_NAMES]).alias("choices"),
        F.when(way == 0, said)
        .when(way == 1, F.concat(said, F.lit(" ")))
        .when(way == 2, F.concat(F.lit("Answer: "), said))
        .when(way == 3, F.concat(F.lit("("), said, F.lit(")")))
        .when(way == 4, F.concat(F.lit("The answer is "), said))
        .when(way == 5, F.concat(F.lit("\n "), said, F.lit(".")))
        .when(way == 6, F.concat(F.lit("My answer: "), said))
        .otherwise(F.lit(""))
        .alias("predicted_answer"),
    )


def sql_choice_preds() -> str:
    return f"""SELECT doc_id, lang, chr(CAST(65 + i AS INT)) AS gold_answer,
        CASE doc_id % 8 WHEN 0 THEN said WHEN 1 THEN said || ' ' WHEN 2 THEN 'Answer: ' || said
            WHEN 3 THEN '(' || said || ')' WHEN 4 THEN 'The answer is ' || said
            WHEN 5 THEN chr(10) || ' ' || said || '.' WHEN 6 THEN 'My answer: ' || said
            ELSE '' END AS predicted_answer
    FROM (SELECT doc_id, lang, i,
            chr(CAST(65 + (CASE WHEN doc_id % 3 = 0 THEN (i + 1) % 4 ELSE i END) AS INT)) AS said
          FROM (SELECT doc_id, lang, {sql_language_index()} AS i FROM documents))"""


def sql_letter(x: str) -> str:
    """Letter extraction for the other engine."""
    text = f"upper({sql_strip(x)})"
    ws = f"[{SPACE_CLASS}]*"
    pattern = rf"(?:ANSWER|CHOICE)?{ws}[:\-]?{ws}\(?([A-H])\)?"
    return (
        f"coalesce(nullif(regexp_extract({text}, '{pattern}', 1), ''), "
        f"nullif(substr({text}, 1, 1), ''), 'A')"
    )


def sql_number(x: str) -> str:
    """Number extraction for the other engine."""
    boxed = rf"nullif(regexp_extract({x}, '\\boxed\{{([^}}]+)\}}', 1), '')"
    plain = f"replace(coalesce({boxed}, {x}), ',', '')"
    return rf"TRY_CAST(nullif(regexp_extract({plain}, '-?\d+(?:\.\d+)?', 0), '') AS DOUBLE)"


def sql_math_score(p: str = "predicted_answer", g: str = "gold_answer") -> str:
    """Score of a numeric answer for the other engine; needs columns pn and gn beside the texts."""
    return (
        f"CASE WHEN pn IS NULL OR gn IS NULL THEN CASE WHEN lower({sql_strip(p)}) = lower({sql_strip(g)}) "
        "THEN 1.0 ELSE 0.0 END WHEN abs(pn - gn) <= CASE WHEN gn <> 0 THEN abs(gn) * 0.01::DOUBLE ELSE "
        "0.01::DOUBLE END THEN 1.0 ELSE 0.0 END"
    )


def sql_math_scored(offset: int = 0) -> str:
    return f"""SELECT *, CAST({sql_math_score()} AS DOUBLE) AS score FROM (
        SELECT *, {sql_number('predicted_answer')} AS pn, {sql_number('gold_answer')} AS gn
        FROM ({sql_math_preds(offset)}))"""


# --- pairs of texts ------------------------------------------------------------------------------
def text_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document against a benchmark passage; where both numbers leave 2 modulo 3 the
    prediction is the passage with a few words more."""
    passages = table(spark, sf_dir, "benchmark").select(
        F.col("item_id").alias("_item"), F.col("text").alias("gold_answer")
    )
    how_many = passages.agg(F.count(F.lit(1))).scalar()
    return (
        dealt(spark, sf_dir, "documents")
        .withColumn("_item", F.col("doc_id") % how_many)
        .join(passages, "_item")
        .select(
            "doc_id",
            "lang",
            "source",
            F.when(
                F.col("doc_id") % 3 == 2, F.concat_ws(" ", "gold_answer", "lang", "source")
            )
            .otherwise(F.col("text"))
            .alias("predicted_answer"),
            "gold_answer",
        )
    )


SQL_TEXT_PAIRS = """SELECT doc_id, lang, source,
        CASE WHEN doc_id % 3 = 2 THEN b.text || ' ' || lang || ' ' || source ELSE d.text END
            AS predicted_answer, b.text AS gold_answer
    FROM documents d JOIN benchmark b ON d.doc_id % (SELECT count(*) FROM benchmark) = b.item_id"""


# --- preference data -----------------------------------------------------------------------------
def completions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents as completions: prompt is (lang, source), reward quality minus toxic."""
    labels = table(spark, sf_dir, "labels")
    return (
        table(spark, sf_dir, "documents")
        .join(labels, "doc_id")
        .select(
            "lang",
            "source",
            "doc_id",
            F.col("text").alias("completion"),
            (F.col("quality") - F.col("toxic")).cast("double").alias("reward"),
        )
    )


SQL_COMPLETIONS = """SELECT lang, source, doc_id, text AS completion,
        CAST(quality - toxic AS DOUBLE) AS reward FROM documents JOIN labels USING (doc_id)"""


def transcripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as transcripts; rejected is the same talk closed by the next talk's last
    assistant text."""
    talks = table(spark, sf_dir, "conversations").where("role <> 'system'")
    marker = F.when(F.col("role") == "user", HUMAN_MARKER).otherwise(ASSISTANT_MARKER)
    marked = talks.withColumn("_marked", F.concat(marker, F.lit(" "), F.col("text")))
    chosen = joined_text(marked, ["conv_id"], "turn", "_marked", "chosen")
    closing = (
        talks.where("role = 'assistant'")
        .groupBy((F.col("conv_id") - 1).alias("conv_id"))
        .agg(F.max_by("text", "turn").alias("_closing"))
    )
    end = F.concat(F.lit(ASSISTANT_MARKER + " "), F.coalesce("_closing", F.lit("none")))
    return chosen.join(closing, "conv_id", "left").select(
        "conv_id", "chosen", F.concat("chosen", end).alias("rejected")
    )


SQL_TRANSCRIPTS = f"""SELECT c.conv_id, c.chosen,
        c.chosen || {quoted(ASSISTANT_MARKER + ' ')} || coalesce(n.closing, 'none') AS rejected
    FROM (SELECT conv_id, string_agg(CASE role WHEN 'user' THEN {quoted(HUMAN_MARKER)}
              ELSE {quoted(ASSISTANT_MARKER)} END || ' ' || text, '' ORDER BY turn) AS chosen
          FROM conversations WHERE role <> 'system' GROUP BY conv_id) c
    LEFT JOIN (SELECT conv_id - 1 AS conv_id, arg_max(text, turn) AS closing
          FROM conversations WHERE role = 'assistant' GROUP BY conv_id) n ON c.conv_id = n.conv_id"""


def sql_hh(columns: str) -> str:
    """The transcript split for the other engine: prompt, chosen, rejected."""
    m = quoted(ASSISTANT_MARKER)

    def response(x: str) -> str:
        last = f"string_split({x}, {m})[-1]"
        return f"CASE WHEN contains({x}, {m}) THEN {sql_strip(last)} ELSE {x} END"

    return f"""SELECT conv_id, CASE WHEN contains(c, {m}) THEN string_split(c, {m})[1] || {m} ELSE '' END
            AS prompt, {response('c')} AS chosen, {response('r')} AS rejected
        FROM (SELECT conv_id, chosen AS c, rejected AS r FROM ({columns}))"""


def buffer_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a log of pairs: seq is the event number, iteration the day."""
    day = F.datediff(F.col("ts"), F.lit("2024-01-01").cast("date")) + 1
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("seq"), day.cast("int").alias("iteration"), "event_type", "value"
    )


SQL_BUFFER_LOG = """SELECT event_id AS seq,
        CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) + 1 AS INT) AS iteration,
        event_type, value FROM events"""


def step_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean value per event type and day as a map; days with an odd number lack purchases and every
    day's map has one entry that is no number."""
    daily = (
        buffer_log(spark, sf_dir)
        .where("event_type <> 'purchase' OR iteration % 2 = 0")
        .groupBy("iteration", "event_type")
        .agg(F.avg("value").alias("value"))
    )
    entries = F.collect_list(F.struct("event_type", "value"))
    label = F.array(
        F.struct(F.lit("label").alias("event_type"), F.lit(None).cast("double").alias("value"))
    )
    return daily.groupBy(F.col("iteration").alias("step")).agg(
        F.map_from_entries(F.concat(entries, label)).alias("stats")
    )


def prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a price history: the user is the symbol, the value the close."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("symbol"), "ts", "event_id", F.col("value").alias("close")
    )


def split_docs(spark: SparkSession, sf_dir: str, train: str = "train", test: str = "test") -> DataFrame:
    """Documents with a split: one in ten is for testing."""
    name = F.when(F.col("doc_id") % 10 < 9, train).otherwise(test)
    return table(spark, sf_dir, "documents").withColumn("split", name)


def sql_split(train: str = "train", test: str = "test") -> str:
    return f"CASE WHEN doc_id % 10 < 9 THEN '{train}' ELSE '{test}' END"
