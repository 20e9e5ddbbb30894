"""Batch inference (I1-I3): the model is the caller's, the distribution is Spark's."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lantern.functions.checks import check_parameters, require
from lantern.functions.text import SLICE_BYTES, col, in_slices, md5_order
from lantern.operators.examples import full_prompt

# called with prompts and one seed per prompt
Predictor = Callable[[list[str], list[int]], Sequence[str]]
Scorer = Callable[[list[str]], Sequence[float]]
# cuts a text to its first n tokens, as the model's tokenizer counts them
Cutter = Callable[[str, int], str]

MAX_PROMPT_TOKENS = 2048
MAX_REWARD_TOKENS = 512
BATCH_SIZE = 64


def in_batches(items: list, work: Callable[[list], list[tuple]], size: int, width: int) -> list[tuple]:
    """``work``'s values for every item plus an error text, null where it went well.

    Items that are null (or whose first part is) get no call. A batch that fails is halved, so that k
    items at fault in a batch of n cost about 2 k log(n) calls more, and the others keep their values.
    """

    def missing(item) -> bool:
        return item is None or (isinstance(item, tuple) and item[0] is None)

    def tried(part: list) -> list[tuple]:
        try:
            return [(*values, None) for values in work(part)]
        except Exception as e:
            if len(part) == 1:
                return [(*[None] * width, str(e))]
            half = len(part) // 2
            return tried(part[:half]) + tried(part[half:])

    asked = [item for item in items if not missing(item)]
    made = iter([row for at in range(0, len(asked), size) for row in tried(asked[at : at + size])])
    return [(*[None] * width, "no prompt") if missing(item) else next(made) for item in items]


def predict(
    df: DataFrame,
    load: Callable[[], Predictor],
    prompt: str = "prompt",
    system: str | None = None,
    seed: Column | None = None,
    cutter: Cutter | None = None,
    batch_size: int = BATCH_SIZE,
    max_prompt_tokens: int = MAX_PROMPT_TOKENS,
) -> DataFrame:
    """``df`` plus predicted_answer and error.

    ``load`` runs once per worker process; the model gets ``batch_size`` prompts at a time, each cut to
    ``max_prompt_tokens`` by the ``cutter``. A prompt whose generation fails keeps its row, with a null
    answer and the error's text; a batch that fails is halved until the prompts at fault are alone.
    """
    require(batch_size > 0, "batch_size must be positive")
    text = col(prompt) if system is None else full_prompt(prompt, system)

    @F.arrow_udf("predicted_answer string, error string")
    def run(parts: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        model = load()

        def some(asked: list[tuple[str, int]]) -> list[tuple[str]]:
            answers = [(a.strip(),) for a in model([p for p, _ in asked], [s for _, s in asked])]
            if len(answers) != len(asked):
                raise ValueError("one answer per prompt is needed")
            return answers

        for batch in parts:
            for prompts, seeds in in_slices(batch, SLICE_BYTES):
                cut = [cutter(p, max_prompt_tokens) if cutter and p else p for p in prompts]
                answers, errors = zip(*in_batches(list(zip(cut, seeds)), some, batch_size, 1))
                yield pa.StructArray.from_arrays(
                    [pa.array(answers, pa.string()), pa.array(errors, pa.string())], ["predicted_answer", "error"]
                )

    made = df.withColumn("_made", run(text, F.lit(0).cast("bigint") if seed is None else seed))
    return made.select(*df.columns, "_made.predicted_answer", "_made.error")


def sample_completions(
    df: DataFrame,
    load: Callable[[], Predictor],
    n: int,
    key: str,
    prompt: str = "prompt",
    system: str | None = None,
    seed: int = 42,
    cutter: Cutter | None = None,
) -> DataFrame:
    """``n`` completions per prompt, each with a seed of its own."""
    check_parameters(samples_per_prompt=n)
    many = df.withColumn("sample_no", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    drawn = md5_order(seed, key, F.col("sample_no"))
    return predict(many, load, prompt, system, drawn, cutter).withColumnRenamed(
        "predicted_answer", "completion"
    )


def reward(
    df: DataFrame,
    load: Callable[[], Scorer],
    prompt: str = "prompt",
    completion: str = "completion",
    cutter: Cutter | None = None,
    batch_size: int = BATCH_SIZE,
) -> DataFrame:
    """``df`` plus one scalar reward per prompt + completion, and error.

    As with answers, a text that cannot be scored keeps its row, with a null reward and the error's text;
    ``batch_size`` texts at a time go to the scorer, and a batch that fails is halved until the texts at
    fault are alone.
    """

    @F.arrow_udf("reward double, error string")
    def run(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        score = load()

        def some(texts: list[str]) -> list[tuple[float]]:
            values = [(float(r),) for r in score(texts)]
            if len(values) != len(texts):
                raise ValueError("one reward per text is needed")
            return values

        for batch in parts:
            for (texts,) in in_slices([batch], SLICE_BYTES):
                cut_texts = [cutter(t, MAX_REWARD_TOKENS) if cutter and t is not None else t for t in texts]
                rewards, errors = zip(*in_batches(cut_texts, some, batch_size, 1))
                yield pa.StructArray.from_arrays(
                    [pa.array(rewards, pa.float64()), pa.array(errors, pa.string())], ["reward", "error"]
                )

    made = df.withColumn("_made", run(F.concat(col(prompt), col(completion))))
    return made.select(*[F.col(f"`{c}`") for c in df.columns], "_made.reward", "_made.error")
