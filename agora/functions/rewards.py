"""Rewards computed from completion texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from agora import fixed_values as fixed
from agora.functions.text import count_of, extract_tagged_answer, is_digits

# (?d) lets only \n end a line and (?U) makes \s cover all whitespace.
_FLAGS = "(?dU)"


def _points(condition: Column, points: float) -> Column:
    return F.when(condition, F.lit(points)).otherwise(F.lit(0.0))


def reward_correct(completion: Column, answer: Column) -> Column:
    return _points(extract_tagged_answer(completion) == answer, 2.0)


def reward_integer(completion: Column) -> Column:
    return _points(is_digits(extract_tagged_answer(completion)), 0.5)


def reward_strict_format(completion: Column) -> Column:
    return _points(
        F.regexp_like(completion, F.lit(_FLAGS + fixed.STRICT_FORMAT_PATTERN)), 0.5
    )


def reward_soft_format(completion: Column) -> Column:
    """The loose pattern has to start the text."""
    return _points(
        F.regexp_like(completion, F.lit(_FLAGS + r"\A" + fixed.SOFT_FORMAT_PATTERN)), 0.5
    )


def reward_tag_count(completion: Column) -> Column:
    """An eighth per tag seen exactly once, less a little per trailing character."""

    def once(tag: str) -> Column:
        return count_of(completion, tag) == 1

    def trailing(tag: str) -> Column:
        return F.length(F.split_part(completion, F.lit(tag), F.lit(-1)))

    points, zero = F.lit(fixed.TAG_POINTS), F.lit(0.0)
    after_line = trailing(fixed.ANSWER_CLOSE_LINE) * fixed.TRAILING_POINTS
    after = (trailing(fixed.ANSWER_CLOSE) - 1) * fixed.TRAILING_POINTS
    return (
        F.when(once(fixed.REASONING_OPEN), points).otherwise(zero)
        + F.when(once(fixed.REASONING_CLOSE), points).otherwise(zero)
        + F.when(once(fixed.ANSWER_OPEN), points - after_line).otherwise(zero)
        + F.when(once(fixed.ANSWER_CLOSE), points - after).otherwise(zero)
    )


def text_rewards(completion: Column, answer: Column) -> dict[str, Column]:
    return {
        "correct": reward_correct(completion, answer),
        "integer": reward_integer(completion),
        "strict_format": reward_strict_format(completion),
        "soft_format": reward_soft_format(completion),
        "tag_count": reward_tag_count(completion),
    }


def reward_exact(completion: Column, wanted: str) -> Column:
    return _points(completion == wanted, 1.0)


def gated_reward(title: Column, matches: Column, score: Column) -> dict[str, Column]:
    """The model score where the title is supported, else 0, and its metrics."""
    metrics = F.create_map(
        F.lit("length"), F.length(title).cast("double"),
        F.lit("matches"), matches.cast("double"),
        F.lit("rm"), score.cast("double"),
    )
    return {"reward": F.when(matches == 0, F.lit(0.0)).otherwise(score), "metrics": metrics}
