"""Row-local expressions over transcripts, token arrays and rewards."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType

from lantern.functions.text import col, strip
from lantern.sources.fixed_values import ASSISTANT_MARKER


def transcript_prompt(chosen: Column | str) -> Column:
    """Text up to and with the first assistant marker; empty without a marker (D3)."""
    chosen = col(chosen)
    found = F.contains(chosen, F.lit(ASSISTANT_MARKER))
    head = F.substring_index(chosen, ASSISTANT_MARKER, 1)
    return F.when(found, F.concat(head, F.lit(ASSISTANT_MARKER))).otherwise(F.lit(""))


def transcript_response(text: Column | str) -> Column:
    """Trimmed text after the last assistant marker; the text as it is without a marker (D3)."""
    text = col(text)
    found = F.contains(text, F.lit(ASSISTANT_MARKER))
    return F.when(found, strip(F.substring_index(text, ASSISTANT_MARKER, -1))).otherwise(text)


def preference_loss(chosen_reward: Column | str, rejected_reward: Column | str) -> Column:
    """-log sigmoid(chosen - rejected), finite for any margin."""
    d = col(chosen_reward) - col(rejected_reward)
    return F.greatest(-d, F.lit(0.0)) + F.log1p(F.exp(-F.abs(d)))


def completion_text(completion: Column | str, kind: DataType) -> Column:
    """Content of the first message of a conversational completion, or the text itself."""
    completion = col(completion)
    if isinstance(kind, ArrayType):
        return F.when(
            F.size(completion) > 0, F.coalesce(completion[0]["content"], F.lit(""))
        ).otherwise(F.lit("[]"))
    return completion.cast("string")


def cut(tokens: Column | str, length: int, keep: str = "start") -> Column:
    """At most ``length`` tokens, from the start or the end."""
    tokens = col(tokens)
    if keep == "start":
        return F.slice(tokens, 1, length)
    if keep == "end":
        return F.slice(tokens, F.greatest(F.size(tokens) - length + 1, F.lit(1)), length)
    raise ValueError(f"keep must be start or end, not {keep}")


def attention_mask(tokens: Column | str, padded_to: int | None = None) -> Column:
    """1 per token, 0 per place of padding."""
    ones = F.array_repeat(F.lit(1), F.size(col(tokens)))
    if padded_to is None:
        return ones
    return F.concat(ones, F.array_repeat(F.lit(0), F.lit(padded_to) - F.size(col(tokens))))


def padded(tokens: Column | str, length: int, pad: int = 0) -> Column:
    """Tokens cut and filled to exactly ``length``."""
    short = cut(tokens, length)
    return F.concat(short, F.array_repeat(F.lit(pad), F.lit(length) - F.size(short)))
