"""Preference data: normalising, ranking, pairing, buffers, losses and advantages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lantern.functions.checks import check_parameters, require
from lantern.functions.preference import (
    attention_mask,
    completion_text,
    cut,
    padded,
    preference_loss,
    transcript_prompt,
    transcript_response,
)
from lantern.operators.ranking import first_per_group, first_rows, rank_within, running_totals
from lantern.operators.skew import HOT_GROUP_ROWS, with_digest
from lantern.operators.tokens import Tokenizer, with_tokenizer, with_vocabulary
from lantern.session import durable

STANDARD = ["prompt", "chosen", "rejected"]


def standardise(
    df: DataFrame,
    prompt: str = "prompt",
    chosen: str = "chosen",
    rejected: str = "rejected",
    keep: Sequence[str] = (),
) -> DataFrame:
    """Any three columns as prompt, chosen, rejected; the rest is dropped."""
    return df.select(
        *keep, *[F.col(have).alias(want) for have, want in zip((prompt, chosen, rejected), STANDARD)]
    )


def split_transcripts(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Two full transcripts -> prompt and two responses (D3). Turns in between are not kept."""
    return df.select(
        *keep,
        transcript_prompt("chosen").alias("prompt"),
        transcript_response("chosen").alias("chosen"),
        transcript_response("rejected").alias("rejected"),
    )


def with_prompt(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """D3 where there are chosen and rejected but no prompt, else unchanged."""
    if {"chosen", "rejected"} <= set(df.columns) and "prompt" not in df.columns:
        return split_transcripts(df, keep)
    return df


def need_prompt(df: DataFrame, method: str) -> None:
    if "prompt" not in df.columns:
        raise ValueError(f"Dataset missing 'prompt' column for {method}")


def prepare_dpo(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The three columns, each required by name."""
    for name in STANDARD:
        if name not in df.columns:
            raise ValueError(f"Dataset missing required column: {name}")
    return df.select(*keep, *STANDARD)


def prepare_online(df: DataFrame) -> DataFrame:
    """Needs a prompt and keeps every column."""
    need_prompt(df, "online_dpo")
    return df


def tokenise_prompts(
    df: DataFrame,
    key: Sequence[str],
    max_length: int | None = 512,
    tokenizer: Tokenizer | None = None,
    vocab: DataFrame | None = None,
) -> DataFrame:
    """prompt, input_ids, attention_mask, query: cut, not padded (D6). None keeps every token."""
    need_prompt(df, "ppo/grpo")
    require(max_length is None or max_length > 0, "max_length must be positive")
    slim = df.select(*key, "prompt")
    if tokenizer is not None:
        coded = with_tokenizer(slim, F.col("prompt"), "input_ids", tokenizer)
    else:
        require(vocab is not None, "a tokenizer or a vocabulary is needed")
        coded = with_vocabulary(slim, {"input_ids": F.col("prompt")}, vocab, max_length)
    if max_length is not None:
        coded = coded.withColumn("input_ids", cut("input_ids", max_length))
    return coded.select(
        *key,
        "prompt",
        "input_ids",
        attention_mask("input_ids").alias("attention_mask"),
        F.col("prompt").alias("query"),
    )


def prepare(
    df: DataFrame,
    method: str,
    key: Sequence[str] = (),
    max_length: int = 512,
    tokenizer: Tokenizer | None = None,
    vocab: DataFrame | None = None,
) -> DataFrame:
    """Preparation by method name, transcripts split first."""
    known = {
        "dpo": lambda d: prepare_dpo(d, key),
        "ppo": lambda d: tokenise_prompts(d, key, max_length, tokenizer, vocab),
        "online_dpo": prepare_online,
        "grpo": lambda d: tokenise_prompts(d, key, max_length, tokenizer, vocab),
    }
    if method not in known:
        raise ValueError(f"Unknown method: {method}. Available: {list(known)}")
    return known[method](with_prompt(df, key))


def dpo_lengths(
    df: DataFrame,
    prompt_ids: str,
    completion_ids: str,
    max_prompt_length: int = 256,
    max_length: int = 512,
    truncation_mode: str = "keep_end",
) -> DataFrame:
    """Prompt cut to its end (or start), then prompt + completion cut to the whole length."""
    check_parameters(truncation_mode=truncation_mode)
    side = truncation_mode.removeprefix("keep_")
    prompt = cut(prompt_ids, max_prompt_length, side)
    return df.withColumn(prompt_ids, prompt).withColumn(
        completion_ids,
        F.slice(F.col(completion_ids), 1, F.greatest(F.lit(max_length) - F.size(prompt_ids), F.lit(0))),
    )


def reward_pairs(
    df: DataFrame,
    key: Sequence[str],
    max_length: int = 512,
    tokenizer: Tokenizer | None = None,
    vocab: DataFrame | None = None,
    pad: int = 0,
) -> DataFrame:
    """prompt+chosen and prompt+rejected as padded ids with masks."""
    for name in STANDARD:
        require(name in df.columns, f"Dataset missing required column: {name}")
    sides = {side: F.concat(F.col("prompt"), F.col(side)) for side in ("chosen", "rejected")}
    slim = df.select(*key, *STANDARD)
    if tokenizer is not None:
        for side, text in sides.items():
            slim = with_tokenizer(slim, text, f"_{side}", tokenizer)
    else:
        require(vocab is not None, "a tokenizer or a vocabulary is needed")
        slim = with_vocabulary(slim, {f"_{s}": t for s, t in sides.items()}, vocab, max_length)
    out = []
    for side in sides:
        out.append(padded(f"_{side}", max_length, pad).alias(f"input_ids_{side}"))
        out.append(
            attention_mask(cut(f"_{side}", max_length), max_length).alias(f"attention_mask_{side}")
        )
    return slim.select(*key, *out)


def limit_splits(
    df: DataFrame,
    key: str,
    train: str = "train",
    test: str = "test",
    max_train: int | None = None,
    max_test: int | None = None,
    split: str = "split",
) -> DataFrame:
    """First rows per split; null or 0 means no limit, a split that is absent stays absent."""
    kept = [
        first_rows(df.where(F.col(split) == name), n, key)
        for name, n in ((train, max_train), (test, max_test))
    ]
    return kept[0].unionByName(kept[1])


def prompt_cap(df: DataFrame, key: str, max_samples: int | None = None) -> DataFrame:
    """The prompts that are generated for: the first ``max_samples``, 1000 unless given (D13). The cap
    comes before the generation, which Spark would not move it across."""
    return first_rows(df, max_samples or 1000, key)


def rank(
    df: DataFrame, group: Sequence[str], sample: str, reward: str | None = "reward", **options: int
) -> DataFrame:
    """Completions of a prompt, best first, earlier ones first on ties; without a reward in the order
    they were generated (D11)."""
    order = [F.col(sample)] if reward is None else [F.col(reward).desc(), F.col(sample)]
    return rank_within(df, group, order, "rank", **options)


def pairs(
    df: DataFrame, group: Sequence[str], sample: str, text: str, reward: str | None = "reward"
) -> DataFrame:
    """Best completion against the last-ranked one per prompt (D12). No ranking is needed: both ends
    are aggregates, combined in each task before the shuffle, whatever the size of a group."""
    # descending order with nulls last, as the ranking has it
    value = F.lit(0.0) if reward is None else F.coalesce(F.col(reward), F.lit(float("-inf")))
    place = F.struct(value.alias("reward"), (-F.col(sample)).alias("sample"))
    return df.groupBy(*group).agg(
        F.max_by(text, place).alias("chosen"),
        F.min_by(text, place).alias("rejected"),
        F.max(place).reward.alias("chosen_reward"),
        F.min(place).reward.alias("rejected_reward"),
        F.count(F.lit(1)).alias("samples"),
    )


def mean_loss(df: DataFrame, chosen: str, rejected: str, by: Sequence[str] = ()) -> DataFrame:
    """Mean preference loss."""
    return df.groupBy(*by).agg(
        F.avg(preference_loss(chosen, rejected)).alias("loss"), F.count(F.lit(1)).alias("pairs")
    )


def completions_with_prompts(
    df: DataFrame, prompts: DataFrame, key: str, completion: str = "completion"
) -> DataFrame:
    """Completion text beside its prompt, matched by key; an unknown prompt is empty."""
    text = completion_text(completion, df.schema[completion].dataType)
    joined = df.withColumn("completion_text", text).join(prompts.select(key, "prompt"), key, "left")
    return joined.withColumn("prompt", F.coalesce("prompt", F.lit("")))


def finished_only(
    df: DataFrame, n_tokens: str, max_length: int, finished: str | None = None
) -> DataFrame:
    """Without completions that hit the length limit unfinished."""
    kept = F.col(n_tokens) < max_length
    return df.where(kept if finished is None else kept | F.col(finished))


def group_advantage(
    df: DataFrame,
    group: Sequence[str],
    reward: str = "reward",
    clip: float | None = None,
    min_group: int = 2,
    hot_rows: int = HOT_GROUP_ROWS,
) -> DataFrame:
    """(reward - group mean) / (group deviation + 1e-4), smaller groups left out.

    Mean and deviation are combined in each task before the shuffle and stored: one row per group.
    Rows join them by shuffle; rows of hot groups join theirs, at most rows / hot_rows, by broadcast.
    """
    check_parameters(num_samples_per_prompt=min_group)
    require(clip is None or clip > 0, "clip must be positive")
    stats = durable(
        df.groupBy(*group)
        .agg(
            F.avg(reward).alias("_mean"),
            F.stddev_samp(reward).alias("_sd"),
            F.count(reward).alias("_n"),
        )
        .where(F.col("_n") >= min_group)
    )
    hot = with_digest(stats.where(F.col("_n") > hot_rows), group).select("_k0", "_k1", "_mean", "_sd", "_n")
    columns = [F.col(f"`{c}`") for c in df.columns]

    def matched(rows: DataFrame) -> DataFrame:
        # a null key is a group like any other
        same = [F.col(f"l.{g}").eqNullSafe(F.col(f"r.{g}")) for g in group]
        both = rows.alias("l").join(stats.alias("r"), same)
        return both.select(*[F.col(f"l.`{c}`") for c in df.columns], *[F.col(f"r.{v}") for v in ("_mean", "_sd", "_n")])

    if hot.isEmpty():
        joined = matched(df)
    else:
        # hot groups go along as 16 bytes and three numbers each, whatever their keys are
        marked = with_digest(df, group)
        cold = marked.join(F.broadcast(hot.select("_k0", "_k1")), ["_k0", "_k1"], "left_anti").select(*columns)
        met = marked.join(F.broadcast(hot), ["_k0", "_k1"])
        joined = matched(cold).unionByName(met.select(*columns, "_mean", "_sd", "_n"))
    advantage = (F.col(reward) - F.col("_mean")) / (F.col("_sd") + 1e-4)
    if clip is not None:
        advantage = F.least(F.greatest(advantage, F.lit(-clip)), F.lit(clip))
    return joined.withColumn("advantage", advantage).drop("_mean", "_sd", "_n")


def buffer(old: DataFrame | None, new: DataFrame, size: int | None, seq: str) -> DataFrame:
    """New pairs appended, the last ``size`` kept; null or 0 keeps all."""
    require(size is None or size >= 0, "size must not be negative")
    return first_rows(new if old is None else old.unionByName(new), size, seq, last=True)


def buffer_snapshots(df: DataFrame, size: int, seq: str, iteration: str) -> DataFrame:
    """The buffer as it stood after each iteration, all iterations in one job.

    A row stays while fewer than ``size`` rows follow it. Rows of an iteration beyond its last ``size``
    are never in any buffer and go before the shuffle; for the rest the rows that follow are those
    of the own iteration (their place from the end) plus whole later iterations (a table of one row
    per iteration, with running totals). Later iterations by which fewer than ``size`` rows have followed
    have totals less than ``size`` away: they meet in cells of that width, each of which has ``size``
    iterations at most. No task sees the iterations of all.
    """
    require(size > 0, "size must be positive")
    recent = first_per_group(df, [iteration], [F.col(seq).desc()], size, "_back")
    counts = df.groupBy(iteration).agg(F.count(F.lit(1)).alias("_n"))
    totals = durable(running_totals(counts, [F.col(iteration)], "_n", "_total"))
    cell = F.floor(F.col("_total") / size)
    later = totals.select(F.col(iteration).alias("_k"), F.col("_total").alias("_t"), cell.alias("_cell"))
    near = totals.select(iteration, "_total", F.explode(F.array(cell, cell + 1)).alias("_cell")).join(later, "_cell")
    gap = F.col("_t") - F.col("_total")
    gaps = near.where((gap >= 0) & (gap < size)).select(F.col(iteration).alias("_it"), "_k", gap.alias("_gap"))
    return (
        recent.join(gaps, F.col(iteration).eqNullSafe(F.col("_it")))
        .where(F.col("_back") - 1 + F.col("_gap") < size)
        .withColumn("snapshot", F.col("_k"))
        .drop("_back", "_it", "_k", "_gap")
    )


def stat_means(df: DataFrame, step: str = "step", stats: str = "stats") -> DataFrame:
    """Mean of each numeric statistic of the first step over all steps that have it."""
    first = df.orderBy(step).limit(1)
    keys = first.select(F.explode(stats).alias("key", "_first")).where("_first is not null")
    values = df.select(F.explode(stats).alias("key", "value"))
    return (
        values.join(keys.select("key"), "key", "left_semi")
        .groupBy("key")
        .agg(F.avg("value").alias("value"))
        .select(F.concat(F.lit("train_"), F.col("key")).alias("key"), "value")
    )


def evaluation_reward(df: DataFrame, reward: str = "reward") -> DataFrame:
    """Mean reward and number of samples; mean 0 without rows."""
    return df.agg(
        F.coalesce(F.avg(reward), F.lit(0.0)).alias("eval_avg_reward"),
        F.count(reward).alias("eval_num_samples"),
    )


def tagged(metrics: DataFrame, iteration: int) -> DataFrame:
    """Metrics with the iteration they belong to, ready to append."""
    check_parameters(num_iterations=iteration)
    return metrics.withColumn("iteration", F.lit(iteration))


def fit_linear_reward(
    df: DataFrame, chosen: str, rejected: str, l2: float = 1e-3, max_iter: int = 50
) -> LogisticRegressionModel:
    """Bradley-Terry fit of a linear reward on feature arrays (D14): logistic regression without
    intercept on feature differences, each pair seen from both sides."""
    d = F.zip_with(chosen, rejected, lambda a, b: a - b)
    minus = F.transform(d, lambda x: -x)
    both = df.select(
        F.explode(
            F.array(
                F.struct(d.alias("d"), F.lit(1.0).alias("label")),
                F.struct(minus.alias("d"), F.lit(0.0).alias("label")),
            )
        ).alias("row")
    ).select(array_to_vector("row.d").alias("features"), "row.label")
    return LogisticRegression(
        fitIntercept=False, regParam=l2, maxIter=max_iter, standardization=False
    ).fit(both)


def linear_reward(features: Column | str, weights: Sequence[float]) -> Column:
    """Reward of a feature array under fitted weights (I3): one dot product in the JVM."""
    features = F.col(features) if isinstance(features, str) else features
    w = F.array(*[F.lit(float(x)) for x in weights])
    return F.aggregate(F.zip_with(features, w, lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x)
