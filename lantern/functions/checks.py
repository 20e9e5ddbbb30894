"""Ranges that parameters must keep to."""

from __future__ import annotations

# Parameter, what it must be, and the test.
RANGES = {
    "num_samples_per_prompt": ("greater than 1", lambda v: v > 1),
    "samples_per_prompt": ("greater than 1", lambda v: v > 1),
    "num_iterations": ("greater than 0", lambda v: v > 0),
    "max_new_tokens": ("greater than 0", lambda v: v > 0),
    "num_beams": ("greater than 0", lambda v: v > 0),
    "eval_interval": ("greater than 0", lambda v: v > 0),
    "warmup_iterations": ("at least 0", lambda v: v >= 0),
    "top_k": ("at least 0", lambda v: v >= 0),
    "beta": ("greater than 0", lambda v: v > 0),
    "temperature": ("greater than 0", lambda v: v > 0),
    "max_grad_norm": ("greater than 0", lambda v: v > 0),
    "top_p": ("greater than 0 and at most 1", lambda v: 0 < v <= 1),
    "label_smoothing": ("between 0 and 1", lambda v: 0 <= v <= 1),
    "replay_ratio": ("between 0 and 1", lambda v: 0 <= v <= 1),
    "truncation_mode": ("keep_end or keep_start", lambda v: v in ("keep_end", "keep_start")),
}


def require(condition: bool, message: str) -> None:
    if not condition:
        raise ValueError(message)


def check_parameters(**given: object) -> None:
    """Each known parameter is in its range; None stands for its default and passes."""
    for name, value in given.items():
        if name not in RANGES:
            raise ValueError(f"Unknown parameter: {name}")
        what, holds = RANGES[name]
        require(value is None or holds(value), f"{name} must be {what}, not {value}")
