"""Queries: preference data and forecasts (D, T)."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lantern.functions.checks import check_parameters
from lantern.functions.vectors import bucket_weights, word_buckets
from lantern.operators import forecast as prices_op
from lantern.operators import preference as pref
from lantern.operators.evaluate import numeric_metrics
from lantern.operators.ranking import joined_text
from lantern.operators.tokens import vocabulary
from lantern.plans.inputs import (
    SQL_BUFFER_LOG,
    SQL_COMPLETIONS,
    SQL_TEXT_PAIRS,
    SQL_TRANSCRIPTS,
    buffer_log,
    completions,
    dealt,
    prices,
    sql_exact_round,
    sql_hh,
    sql_words,
    step_stats,
    table,
    text_pairs,
    transcripts,
)
from lantern.session import durable, fresh_path
from lantern.sources.tables import read_prices

Frame = DataFrame
GROUP = ["lang", "source"]
BUFFER = 500


# --- shaping -------------------------------------------------------------------------------------
def hh_format(spark: SparkSession, sf_dir: str) -> Frame:
    return pref.split_transcripts(transcripts(spark, sf_dir), keep=["conv_id"])


SQL_HH = sql_hh(SQL_TRANSCRIPTS)


def chat_flatten(spark: SparkSession, sf_dir: str) -> Frame:
    return joined_text(table(spark, sf_dir, "conversations"), ["conv_id"], "turn", "text", "flat")


SQL_FLATTEN = "SELECT conv_id, string_agg(text, '' ORDER BY turn) AS flat FROM conversations GROUP BY 1"


def pref_rename(spark: SparkSession, sf_dir: str) -> Frame:
    """Text pairs as question, response_j, response_k in the standard names."""
    raw = text_pairs(spark, sf_dir).select(
        "doc_id",
        F.concat_ws("/", "lang", "source").alias("question"),
        F.col("gold_answer").alias("response_j"),
        F.col("predicted_answer").alias("response_k"),
    )
    return pref.standardise(raw, "question", "response_j", "response_k", keep=["doc_id"])


SQL_RENAME = f"""SELECT doc_id, lang || '/' || source AS prompt, gold_answer AS chosen,
    predicted_answer AS rejected FROM ({SQL_TEXT_PAIRS})"""


def dpo_validate(spark: SparkSession, sf_dir: str) -> Frame:
    """Transcripts prepared for DPO: split, checked, other columns dropped."""
    extra = transcripts(spark, sf_dir).withColumn("note", F.lit("dropped"))
    return pref.prepare(extra, "dpo", key=["conv_id"])


def online_validate(spark: SparkSession, sf_dir: str) -> Frame:
    """Prompts for online DPO: a prompt is needed, every column stays."""
    users = table(spark, sf_dir, "conversations").where("role = 'user'")
    return pref.prepare(users.withColumnRenamed("text", "prompt"), "online_dpo")


SQL_ONLINE = "SELECT conv_id, turn, role, text AS prompt FROM conversations WHERE role = 'user'"


def prompt_cap(spark: SparkSession, sf_dir: str) -> Frame:
    """The prompts generated for: the first 1000 documents."""
    prompts = table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("prompt"))
    return pref.prompt_cap(prompts, "doc_id").select("doc_id", F.length("prompt").alias("length"))


SQL_PROMPT_CAP = """SELECT doc_id, CAST(length(text) AS INT) AS length FROM documents
    ORDER BY doc_id LIMIT 1000"""


# --- ranking and rewards -------------------------------------------------------------------------
def rank_completions(spark: SparkSession, sf_dir: str) -> Frame:
    slim = completions(spark, sf_dir).select(*GROUP, "doc_id", "reward")
    return pref.rank(slim, GROUP, "doc_id")


SQL_RANK = f"""SELECT lang, source, doc_id, reward, CAST(row_number() OVER
    (PARTITION BY lang, source ORDER BY reward DESC, doc_id) AS INT) AS rank FROM ({SQL_COMPLETIONS})"""


def rank_hot_groups(spark: SparkSession, sf_dir: str) -> Frame:
    """The same ranks with nine rows already counting as too many for one task."""
    slim = completions(spark, sf_dir).select(*GROUP, "doc_id", "reward")
    return pref.rank(slim, GROUP, "doc_id", hot_rows=8)


def rank_without_reward(spark: SparkSession, sf_dir: str) -> Frame:
    slim = completions(spark, sf_dir).select("lang", "doc_id")
    return pref.rank(slim, ["lang"], "doc_id", reward=None)


SQL_RANK_PLAIN = f"""SELECT lang, doc_id, CAST(row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS INT)
    AS rank FROM ({SQL_COMPLETIONS})"""


def pref_pairs(spark: SparkSession, sf_dir: str) -> Frame:
    return pref.pairs(completions(spark, sf_dir), GROUP, "doc_id", "completion")


SQL_PAIRS = f"""WITH r AS (SELECT *,
        row_number() OVER (PARTITION BY lang, source ORDER BY reward DESC, doc_id) AS best,
        row_number() OVER (PARTITION BY lang, source ORDER BY reward, doc_id DESC) AS worst,
        count(*) OVER (PARTITION BY lang, source) AS samples FROM ({SQL_COMPLETIONS}))
    SELECT a.lang, a.source, a.completion AS chosen, b.completion AS rejected, a.reward AS chosen_reward,
        b.reward AS rejected_reward, a.samples FROM r a JOIN r b ON a.lang = b.lang AND a.source = b.source
    WHERE a.best = 1 AND b.worst = 1"""


def bt_loss(spark: SparkSession, sf_dir: str) -> Frame:
    pairs = pref.pairs(completions(spark, sf_dir), GROUP, "doc_id", "doc_id")
    return pref.mean_loss(pairs, "chosen_reward", "rejected_reward", ["lang"]).withColumn(
        "loss", F.round("loss", 8)
    )


SQL_LOSS = f"""SELECT lang, round(avg(greatest(-d, 0) + ln(1 + exp(-abs(d)))), 8) AS loss, count(*) AS pairs
    FROM (SELECT lang, max(reward) - min(reward) AS d FROM ({SQL_COMPLETIONS}) GROUP BY lang, source) GROUP BY 1"""


def completion_text(spark: SparkSession, sf_dir: str) -> Frame:
    """Conversational completions: a talk's assistant texts as messages, matched to its first text
    by key (D18)."""
    talks = table(spark, sf_dir, "conversations")
    replies = talks.where("role = 'assistant'").select(
        "conv_id", "turn", F.array(F.struct("role", F.col("text").alias("content"))).alias("completion")
    )
    prompts = talks.where("turn = 1 AND role = 'user'").select("conv_id", F.col("text").alias("prompt"))
    return pref.completions_with_prompts(replies, prompts, "conv_id").select(
        "conv_id", "turn", "prompt", "completion_text"
    )


SQL_COMPLETION_TEXT = """SELECT c.conv_id, c.turn, coalesce(p.text, '') AS prompt, c.text AS completion_text
    FROM conversations c LEFT JOIN (SELECT conv_id, text FROM conversations WHERE turn = 1 AND role = 'user') p
    ON c.conv_id = p.conv_id WHERE c.role = 'assistant'"""


def group_advantage(spark: SparkSession, sf_dir: str) -> Frame:
    slim = completions(spark, sf_dir).select(*GROUP, "doc_id", "reward")
    return pref.group_advantage(slim, GROUP, clip=10.0).withColumn("advantage", F.round("advantage", 6))


SQL_ADVANTAGE = f"""SELECT lang, source, doc_id, reward,
    round(least(greatest((reward - m) / (s + 1e-4::DOUBLE), -10.0), 10.0), 6) AS advantage
    FROM (SELECT *, avg(reward) OVER w AS m, stddev_samp(reward) OVER w AS s, count(reward) OVER w AS n
        FROM ({SQL_COMPLETIONS}) WINDOW w AS (PARTITION BY lang, source)) WHERE n > 1"""


def advantage_hot_groups(spark: SparkSession, sf_dir: str) -> Frame:
    """The same advantages with nine rows already counting as a hot group."""
    slim = completions(spark, sf_dir).select(*GROUP, "doc_id", "reward")
    made = pref.group_advantage(slim, GROUP, clip=10.0, hot_rows=8)
    return made.withColumn("advantage", F.round("advantage", 6))


def drop_truncated(spark: SparkSession, sf_dir: str) -> Frame:
    """Completions that stopped by themselves: fewer than 256 words, or ended by a full stop."""
    words = F.size(F.split("completion", " "))
    rows = completions(spark, sf_dir).select(
        "doc_id", words.alias("n_tokens"), F.endswith("completion", F.lit(".")).alias("finished")
    )
    return pref.finished_only(rows, "n_tokens", 256, "finished")


SQL_TRUNCATED = f"""SELECT * FROM (SELECT doc_id, CAST(len(string_split(completion, ' ')) AS INT) AS n_tokens,
    ends_with(completion, '.') AS finished FROM ({SQL_COMPLETIONS})) WHERE n_tokens < 256 OR finished"""


# --- buffers and statistics ----------------------------------------------------------------------
def replay_buffer(spark: SparkSession, sf_dir: str) -> Frame:
    """A stored buffer and a new batch: appended, the last 500 kept."""
    log = buffer_log(spark, sf_dir)
    path = fresh_path(spark, "buffer")
    pref.buffer(None, log.where("iteration <= 15"), BUFFER, "seq").write.parquet(path)
    return pref.buffer(spark.read.parquet(path), log.where("iteration > 15"), BUFFER, "seq")


SQL_BUFFER = f"SELECT * FROM ({SQL_BUFFER_LOG}) ORDER BY seq DESC LIMIT {BUFFER}"


def buffer_snapshots(spark: SparkSession, sf_dir: str) -> Frame:
    return pref.buffer_snapshots(buffer_log(spark, sf_dir), BUFFER, "seq", "iteration").select(
        "snapshot", "iteration", "seq", "value"
    )


SQL_SNAPSHOTS = f"""WITH e AS ({SQL_BUFFER_LOG}) SELECT k.iteration AS snapshot, e.iteration, e.seq, e.value
    FROM (SELECT DISTINCT iteration FROM e) k JOIN e ON e.iteration <= k.iteration
    QUALIFY row_number() OVER (PARTITION BY k.iteration ORDER BY e.iteration DESC, e.seq DESC) <= {BUFFER}"""


def stat_means(spark: SparkSession, sf_dir: str) -> Frame:
    return pref.stat_means(step_stats(spark, sf_dir)).withColumn("value", F.round("value", 6))


SQL_STATS = f"""WITH d AS (SELECT iteration AS step, event_type, avg(value) AS value FROM ({SQL_BUFFER_LOG})
        WHERE event_type <> 'purchase' OR iteration % 2 = 0 GROUP BY 1, 2)
    SELECT 'train_' || event_type AS key, round(avg(value), 6) AS value FROM d
    WHERE event_type IN (SELECT event_type FROM d WHERE step = (SELECT min(step) FROM d)) GROUP BY 1"""


def eval_reward(spark: SparkSession, sf_dir: str) -> Frame:
    """Mean reward and count; the mean of no rows is 0."""
    rows = completions(spark, sf_dir)
    some = pref.evaluation_reward(rows).withColumn("of", F.lit("all"))
    none = pref.evaluation_reward(rows.where("lang = 'xx'")).withColumn("of", F.lit("none"))
    return some.unionByName(none).withColumn("eval_avg_reward", F.round("eval_avg_reward", 8))


SQL_EVAL_REWARD = f"""SELECT 'all' AS of, round(avg(reward), 8) AS eval_avg_reward,
    count(*) AS eval_num_samples FROM ({SQL_COMPLETIONS}) UNION ALL SELECT 'none', 0.0::DOUBLE, 0"""


def iteration_metrics(spark: SparkSession, sf_dir: str) -> Frame:
    """Metrics of three iterations, tagged, appended and read back."""
    path = fresh_path(spark, "iterations")
    log = buffer_log(spark, sf_dir)
    last = log.agg(F.max("iteration")).first()[0] or 0
    for i in (1, 2, 3):
        upto = log.where(F.col("iteration") * 3 <= last * i)
        means = upto.groupBy(F.col("event_type").alias("key")).agg(F.avg("value").alias("value"))
        pref.tagged(means, i).write.mode("append").parquet(path)
    return numeric_metrics(spark.read.parquet(path))


SQL_ITERATIONS = f"""SELECT i.iteration, event_type AS key, round(avg(value), 4) AS value
    FROM ({SQL_BUFFER_LOG}) e JOIN (VALUES (1), (2), (3)) AS i(iteration)
        ON e.iteration * 3 <= i.iteration * (SELECT max(iteration) FROM ({SQL_BUFFER_LOG}) l)
    GROUP BY 1, 2"""


# --- tokens --------------------------------------------------------------------------------------
def talk_vocabulary(spark: SparkSession, sf_dir: str) -> Frame:
    return vocabulary(dealt(spark, sf_dir, "conversations"), "text")


SQL_VOCABULARY = f"""SELECT word, n, CAST(row_number() OVER (ORDER BY n DESC, word) - 1 AS INT) AS id
    FROM (SELECT word, count(*) AS n FROM (SELECT unnest({sql_words('text')}) AS word FROM conversations)
        GROUP BY 1)"""


def numbers_text(name: str):
    return F.array_join(F.col(name).cast("array<string>"), ",").alias(name)


def tokenise_prompts(spark: SparkSession, sf_dir: str) -> Frame:
    talks = dealt(spark, sf_dir, "conversations").withColumnRenamed("text", "prompt")
    coded = pref.prepare(
        talks, "grpo", key=["conv_id", "turn"], max_length=512, vocab=talk_vocabulary(spark, sf_dir)
    )
    return coded.select(
        "conv_id", "turn", "query", numbers_text("input_ids"), numbers_text("attention_mask")
    )


SQL_TOKENISE = f"""WITH v AS MATERIALIZED ({SQL_VOCABULARY}),
    w AS (SELECT conv_id, turn, text, unnest(list_slice({sql_words('text')}, 1, 512)) AS word,
        generate_subscripts(list_slice({sql_words('text')}, 1, 512), 1) AS i FROM conversations)
    SELECT w.conv_id, w.turn, w.text AS query, string_agg(CAST(v.id AS VARCHAR), ',' ORDER BY i) AS input_ids,
        string_agg('1', ',') AS attention_mask FROM w JOIN v ON w.word = v.word GROUP BY ALL"""


def pair_tokens(spark: SparkSession, sf_dir: str) -> tuple[Frame, Frame]:
    # read several times from here on
    formatted = durable(hh_format(spark, sf_dir))
    vocab = vocabulary(formatted, "prompt", "chosen", "rejected")
    return formatted, vocab


def reward_pairs(spark: SparkSession, sf_dir: str) -> Frame:
    formatted, vocab = pair_tokens(spark, sf_dir)
    coded = pref.reward_pairs(formatted, ["conv_id"], 512, vocab=vocab)
    return coded.select("conv_id", *[numbers_text(c) for c in coded.columns[1:]])


SQL_PAIR_VOCABULARY = f"""SELECT word, CAST(row_number() OVER (ORDER BY count(*) DESC, word) - 1 AS INT) AS id
    FROM (SELECT unnest(list_concat(list_concat({sql_words('prompt')}, {sql_words('chosen')}),
        {sql_words('rejected')})) AS word FROM hh) GROUP BY word"""


def sql_side(text: str, limit: str = "") -> str:
    words = f"list_slice({sql_words(text)}, {limit})" if limit else sql_words(text)
    return f"""SELECT conv_id, list(coalesce(v.id, (SELECT count(*) FROM v)) ORDER BY i) AS ids FROM (SELECT conv_id, unnest({words}) AS word,
        generate_subscripts({words}, 1) AS i FROM hh) w LEFT JOIN v ON w.word = v.word GROUP BY conv_id"""


def sql_padded(ids: str, name: str) -> str:
    return f"""array_to_string(list_resize(coalesce({ids}, []), 512, 0), ',') AS input_ids_{name},
        array_to_string(list_resize(list_transform(coalesce({ids}, []), lambda x: 1), 512, 0), ',')
        AS attention_mask_{name}"""


SQL_REWARD_PAIRS = f"""WITH hh AS MATERIALIZED ({SQL_HH}), v AS MATERIALIZED ({SQL_PAIR_VOCABULARY}),
    c AS ({sql_side('prompt || chosen', '1, 512')}), r AS ({sql_side('prompt || rejected', '1, 512')})
    SELECT hh.conv_id, {sql_padded('c.ids', 'chosen')}, {sql_padded('r.ids', 'rejected')}
    FROM hh LEFT JOIN c ON hh.conv_id = c.conv_id LEFT JOIN r ON hh.conv_id = r.conv_id"""


def dpo_lengths(spark: SparkSession, sf_dir: str) -> Frame:
    """Prompt cut to its last 40 tokens, prompt and completion together to 100."""
    formatted, vocab = pair_tokens(spark, sf_dir)
    prompts = pref.tokenise_prompts(formatted, ["conv_id"], None, vocab=vocab)
    chosen = pref.tokenise_prompts(
        formatted.select("conv_id", F.col("chosen").alias("prompt")), ["conv_id"], None, vocab=vocab
    )
    both = prompts.select("conv_id", F.col("input_ids").alias("prompt_ids")).join(
        chosen.select("conv_id", F.col("input_ids").alias("chosen_ids")), "conv_id"
    )
    cut = pref.dpo_lengths(both, "prompt_ids", "chosen_ids", 40, 100)
    return cut.select("conv_id", numbers_text("prompt_ids"), numbers_text("chosen_ids"))


SQL_DPO_LENGTHS = f"""WITH hh AS MATERIALIZED ({SQL_HH}), v AS MATERIALIZED ({SQL_PAIR_VOCABULARY}),
    p AS ({sql_side('prompt')}), c AS ({sql_side('chosen')})
    SELECT hh.conv_id, array_to_string(p.kept, ',') AS prompt_ids,
        array_to_string(list_slice(coalesce(c.ids, []), 1, 100 - len(p.kept)), ',') AS chosen_ids
    FROM hh JOIN (SELECT hh.conv_id, list_slice(coalesce(p.ids, []), greatest(len(coalesce(p.ids, [])) - 39, 1),
        len(coalesce(p.ids, []))) AS kept FROM hh LEFT JOIN p ON hh.conv_id = p.conv_id) p ON hh.conv_id = p.conv_id
    LEFT JOIN c ON hh.conv_id = c.conv_id"""


def linear_reward_fit(spark: SparkSession, sf_dir: str) -> Frame:
    """A linear reward fitted on every completion against the next one in its group's ranking (D14): the
    number of pairs, whether the loss falls below that of no reward, and whether most are ordered rightly."""
    size = 16
    places = durable(pref.rank(completions(spark, sf_dir), GROUP, "doc_id"))
    better = places.select(*GROUP, "rank", F.col("completion").alias("chosen"), F.col("reward").alias("more"))
    worse = places.select(
        *GROUP, (F.col("rank") - 1).alias("rank"), F.col("completion").alias("rejected"), F.col("reward").alias("less")
    )
    pairs = better.join(worse, [*GROUP, "rank"]).where("more > less")
    features = pairs.select(
        *[bucket_weights(word_buckets(side, size), size).alias(side) for side in ("chosen", "rejected")]
    )
    model = pref.fit_linear_reward(features, "chosen", "rejected")
    weights = model.coefficients.toArray().tolist()
    scored = features.select(
        pref.linear_reward("chosen", weights).alias("c"), pref.linear_reward("rejected", weights).alias("r")
    )
    return scored.agg(
        F.count(F.lit(1)).alias("pairs"),
        (F.avg(pref.preference_loss("c", "r")) < math.log(2)).alias("loss_falls"),
        (F.avg((F.col("c") > F.col("r")).cast("int")) > 0.5).alias("most_ordered"),
    )


SQL_LINEAR_REWARD = f"""SELECT count(*) AS pairs, true AS loss_falls, true AS most_ordered FROM (SELECT reward,
        lead(reward) OVER (PARTITION BY lang, source ORDER BY reward DESC, doc_id) AS less
    FROM ({SQL_COMPLETIONS})) WHERE reward > less"""


# --- forecasts -----------------------------------------------------------------------------------
ORDER = ("ts", "event_id")


def last_history(spark: SparkSession, sf_dir: str) -> Frame:
    return prices_op.last_rows_per_symbol(prices(spark, sf_dir), "symbol", ORDER).select(
        "symbol", "event_id", "close"
    )


SQL_LAST5 = """SELECT user_id AS symbol, event_id, value AS close FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) <= 5"""


def price_history(spark: SparkSession, sf_dir: str) -> Frame:
    """The histories of all symbols that a table of orders names, from a price table of files."""
    path = fresh_path(spark, "prices")
    prices(spark, sf_dir).write.parquet(path)
    wanted = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("symbol"))
    return read_prices(spark, path, wanted).select("symbol", "event_id", "close")


SQL_PRICES = """SELECT user_id AS symbol, event_id, value AS close FROM events
    WHERE user_id IN (SELECT o_custkey FROM orders)"""


def parameter_checks(spark: SparkSession, sf_dir: str) -> Frame:
    """Settings of a training run as the data has them, each held against its range."""
    given = table(spark, sf_dir, "lineitem").agg(
        F.max("l_quantity").alias("max_new_tokens"),
        F.min(-F.col("l_quantity")).alias("num_beams"),
        F.max("l_discount").alias("top_p"),
        F.max(F.col("l_tax") + 1).alias("label_smoothing"),
        F.min("l_discount").alias("beta"),
    )
    rows = []
    for name, value in given.first().asDict().items():
        try:
            check_parameters(**{name: value})
            rows.append((name, True))
        except ValueError:
            rows.append((name, False))
    return spark.createDataFrame(rows, "name string, valid boolean")


SQL_PARAMETERS = """SELECT 'max_new_tokens' AS name, max(l_quantity) > 0 AS valid FROM lineitem
    UNION ALL SELECT 'num_beams', min(-l_quantity) > 0 FROM lineitem
    UNION ALL SELECT 'top_p', max(l_discount) > 0 AND max(l_discount) <= 1 FROM lineitem
    UNION ALL SELECT 'label_smoothing', max(l_tax + 1) BETWEEN 0 AND 1 FROM lineitem
    UNION ALL SELECT 'beta', min(l_discount) > 0 FROM lineitem"""


def forecast_last5(spark: SparkSession, sf_dir: str) -> Frame:
    made = prices_op.forecast(prices(spark, sf_dir), order=ORDER)
    history = F.array_join(F.transform("details", lambda d: d.close.cast("string")), ";")
    return made.select("symbol", "prediction", "summary", history.alias("details"))


SQL_FORECAST = f"""SELECT symbol, prediction, 'Predicted price for ' || symbol || ' is $' || prediction AS summary,
        details FROM (SELECT symbol, {sql_exact_round('mean', 2)} AS prediction, details
        FROM (SELECT symbol, avg(close) AS mean, string_agg(CAST(close AS VARCHAR), ';' ORDER BY t, event_id) AS details
        FROM (SELECT l.*, e.ts AS t FROM ({SQL_LAST5}) l JOIN events e ON l.event_id = e.event_id) GROUP BY 1))"""


def forecast_rolling(spark: SparkSession, sf_dir: str) -> Frame:
    made = prices_op.rolling_forecast(prices(spark, sf_dir), order=ORDER)
    return made.select("symbol", "event_id", F.round("forecast", 6).alias("forecast"))


def forecast_rolling_slots(spark: SparkSession, sf_dir: str) -> Frame:
    """The same forecasts with long symbols done day by day."""
    made = prices_op.rolling_forecast(prices(spark, sf_dir), order=ORDER, hot_rows=60)
    return made.select("symbol", "event_id", F.round("forecast", 6).alias("forecast"))


SQL_ROLLING = """SELECT user_id AS symbol, event_id, round(avg(value) OVER (PARTITION BY user_id
    ORDER BY ts, event_id ROWS BETWEEN 4 PRECEDING AND CURRENT ROW), 6) AS forecast FROM events"""

QUERIES = {
    "hh_format": (hh_format, SQL_HH),
    "chat_flatten": (chat_flatten, SQL_FLATTEN),
    "pref_rename": (pref_rename, SQL_RENAME),
    "dpo_validate": (dpo_validate, SQL_HH),
    "online_validate": (online_validate, SQL_ONLINE),
    "prompt_cap": (prompt_cap, SQL_PROMPT_CAP),
    "rank_completions": (rank_completions, SQL_RANK),
    "rank_hot_groups": (rank_hot_groups, SQL_RANK),
    "rank_without_reward": (rank_without_reward, SQL_RANK_PLAIN),
    "pref_pairs": (pref_pairs, SQL_PAIRS),
    "bt_loss": (bt_loss, SQL_LOSS),
    "completion_text": (completion_text, SQL_COMPLETION_TEXT),
    "group_advantage": (group_advantage, SQL_ADVANTAGE),
    "advantage_hot_groups": (advantage_hot_groups, SQL_ADVANTAGE),
    "drop_truncated": (drop_truncated, SQL_TRUNCATED),
    "replay_buffer": (replay_buffer, SQL_BUFFER),
    "buffer_snapshots": (buffer_snapshots, SQL_SNAPSHOTS),
    "stat_means": (stat_means, SQL_STATS),
    "eval_reward": (eval_reward, SQL_EVAL_REWARD),
    "iteration_metrics": (iteration_metrics, SQL_ITERATIONS),
    "token_vocabulary": (talk_vocabulary, SQL_VOCABULARY),
    "tokenise_prompts": (tokenise_prompts, SQL_TOKENISE),
    "reward_pairs": (reward_pairs, SQL_REWARD_PAIRS),
    "dpo_lengths": (dpo_lengths, SQL_DPO_LENGTHS),
    "linear_reward_fit": (linear_reward_fit, SQL_LINEAR_REWARD),
    "last_history": (last_history, SQL_LAST5),
    "price_history": (price_history, SQL_PRICES),
    "parameter_checks": (parameter_checks, SQL_PARAMETERS),
    "forecast_last5": (forecast_last5, SQL_FORECAST),
    "forecast_rolling": (forecast_rolling, SQL_ROLLING),
    "forecast_rolling_slots": (forecast_rolling_slots, SQL_ROLLING),
}
