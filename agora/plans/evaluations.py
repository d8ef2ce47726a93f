"""Jobs that score, compare and report."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agora import fixed_values as fixed
from agora.functions.numbers import score_from_log
from agora.functions.rewards import gated_reward
from agora.functions.stories import day, request_problem, score_request, serialize_with_title, with_link
from agora.functions.text import parse_flag, parse_reasoning, unescape_html
from agora.operators.joins import join_metrics, with_story_info
from agora.operators.metrics import metrics_by_split, presence_rates
from agora.operators.prompting import prompt_steps
from agora.operators.ranking import bottom_n, top_n
from agora.operators.sampling import sample_n
from agora.operators.scoring import Scorer, batch_score, length_scorer, score_columns


def with_predicted_score(df: DataFrame) -> DataFrame:
    """Whole-number score from the log prediction, and the miss against the true score."""
    predicted = df.withColumn("predicted_score", score_from_log(F.col("predictions")))
    return predicted.withColumn("score_diff", F.col("score") - F.col("predicted_score"))


def compare_models(
    predictions: dict[str, DataFrame], label: str = "log_score"
) -> DataFrame:
    """Metrics by model and split, for several prediction tables at once."""
    tagged = [
        df.select(F.lit(name).alias("model"), "split", label, "predictions")
        for name, df in predictions.items()
    ]
    return metrics_by_split(
        reduce(DataFrame.unionByName, tagged), label, split=["model", "split"]
    )


def evaluate_reasoning(
    stories: DataFrame, completions: DataFrame, label: str = "label"
) -> DataFrame:
    """Metrics of think-then-answer completions, with how often each part is there.

    ``completions`` holds id and completion; the answer is read from the
    completion.
    """
    parsed = completions.select("id", *[
        column.alias(name) for name, column in parse_reasoning(F.col("completion")).items()
    ])
    joined = stories.select("id", label, "split").join(parsed, "id")
    return join_metrics(metrics_by_split(joined, label), presence_rates(joined))


def rate_comments(
    comments: DataFrame,
    items: DataFrame,
    scorer: Scorer = length_scorer,
    sample_size: int | None = fixed.COMMENT_SAMPLE_SIZE,
    reader=None,
) -> DataFrame:
    """Score comments through their prompt and prepare them for reading.

    ``sample_size`` of None rates every comment.  Prompts are made and scored in steps.  Where the texts of
    comments and items are stored apart, ``reader`` adds them.
    """
    chosen = comments if sample_size is None else sample_n(comments, sample_size)
    prompts = prompt_steps(chosen.select("id"), items, ("v1",), reader)
    rewards = prompts.each(lambda made: batch_score(made, "id", "prompt_v1", scorer), "rewards").select(
        "id", F.col("score").alias("reward"), F.col("error").alias("reward_error")
    )
    # Titles meet rewards on ids; comment texts are moved once, at the end.
    facts = with_story_info(chosen.select("id", "top_level_parent"), items).join(rewards, "id")
    rated = chosen.join(facts.select("id", "story_title", "reward", "reward_error"), "id")
    return (rated if reader is None else reader(rated)).select(
        "id",
        day(F.col("time"), fixed.LONG_DATE_FORMAT).alias("date"),
        "by",
        with_link(F.col("id")).alias("link"),
        "story_title",
        unescape_html(F.col("text")).alias("text"),
        "reward",
        "reward_error",
    )


def reward_titles(
    stories: DataFrame, proposed: DataFrame, scorer: Scorer = length_scorer
) -> DataFrame:
    """``(id, title, reward, metrics, error)`` of proposed titles.

    ``proposed`` holds id, title and verdict, the answer to ``match_prompt``.  A
    title is scored in its story's place; without support its reward is 0.  A
    story that lacks a required field has no score, and ``error`` says why.
    ``distribution_summary`` and ``metric_summaries`` read the result.
    """
    title = F.col("title")
    ready = proposed.join(stories.select("id", "by", "url", "time", "scraped_body"), "id")
    ready = ready.withColumn("problem", request_problem(score_request(title))).select(
        "id", "title", "problem", parse_flag(F.col("verdict")).alias("matches"),
        F.when(F.col("problem").isNull(), serialize_with_title(title)).alias("_story"),
    )
    scored = score_columns(ready, {"_story": "rm"}, scorer, drop_texts=True)
    gated = gated_reward(title, F.col("matches"), F.col("rm"))
    return scored.select(
        "id", "title", gated["reward"].alias("reward"), gated["metrics"].alias("metrics"),
        F.coalesce("problem", "rm_error").alias("error"),
    )


def rating_reports(rated: DataFrame, n: int = 100) -> dict[str, DataFrame]:
    """The best and the worst rated comments."""
    return {"top": top_n(rated, "reward", n), "bottom": bottom_n(rated, "reward", n)}
