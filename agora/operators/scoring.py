"""Batched scoring of texts.

A scorer is a factory without arguments.  It is called once per task, so that
a model is loaded once, and returns a function from a list of texts to a list
of numbers.

A batch costs what its longest text costs, as often as it has rows.  Batches therefore hold
texts of like length and are closed by that padded size.  ``balanced`` also deals the
rows to tasks by it: lengths are counted in narrow classes, the classes' costs are summed in
order, and each task takes an equal stretch of the sum, however the lengths are spread.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from agora.functions.stories import request_problem, score_request, serialize_with_title
from agora.functions.text import clean_title
from agora.operators.joins import attach
from agora.sources.staging import stage

Scorer = Callable[[], Callable[[list[str]], list[float | None]]]

DEFAULT_BATCH = 1000
#: Characters of a padded batch: its rows times its longest text.
DEFAULT_PADDED = 4_000_000
#: Characters of the rows that a task puts in order of length at a time.
_SORTED = 16_000_000
#: Classes of lengths for each doubling.
_CLASSES = 16


def length_scorer() -> Callable[[list[str]], list[float]]:
    """Built-in scorer: the log of one plus the number of characters."""
    return lambda texts: [math.log1p(len(text)) for text in texts]


def _values_and_errors(score, texts: list[str]) -> list[tuple[float | None, str | None]]:
    """Results of one batch; a batch that fails is halved until the bad rows stand alone."""
    try:
        values = list(score(texts))
        if len(values) != len(texts):
            raise ValueError(f"scorer returned {len(values)} values for {len(texts)} texts")
        return [(value, None) for value in values]
    except Exception as failure:  # a scorer may raise anything
        if len(texts) < 2:
            return [(None, f"{type(failure).__name__}: {failure}") for _ in texts]
        half = len(texts) // 2
        return _values_and_errors(score, texts[:half]) + _values_and_errors(score, texts[half:])


def score_columns(
    df: DataFrame,
    texts: dict[str, str],
    scorer: Scorer = length_scorer,
    batch_size: int = DEFAULT_BATCH,
    longest_first: bool = True,
    drop_texts: bool = False,
    padded: int = DEFAULT_PADDED,
    tasks: int | None = None,
) -> DataFrame:
    """Score text columns in place; ``texts`` maps a text column to its score column.

    Each score column gets an ``<name>_error`` beside it: a row the scorer
    fails on keeps the error and a null score.  Null texts get a null score.
    A task takes rows of some million characters at a time and puts them longest first, so that
    texts of like length share a batch and little is padded; a batch ends at ``batch_size`` rows or
    ``padded`` characters, whichever comes first.  Scores stay in their row, so nothing is
    shuffled, no order has to be restored and no text is written to disk.  With ``tasks`` the rows are dealt anew to
    so many tasks of equal cost, which pays where scoring costs more than moving the texts.
    """
    kept = [f for f in df.schema.fields if not (drop_texts and f.name in texts)]
    added = [
        T.StructField(name, kind)
        for out in texts.values()
        for name, kind in ((out, T.DoubleType()), (f"{out}_error", T.StringType()))
    ]
    if tasks is not None:
        df = balanced(df, list(texts), tasks)
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        score = scorer()
        for frame in _longest_first(frames, list(texts)) if longest_first else frames:
            for begin, end in _batches(frame[list(texts)], batch_size, padded):
                part = frame.iloc[begin:end]
                result = part[[f.name for f in kept]].copy()
                for text, out in texts.items():
                    known = part[text].notna()
                    pairs = _values_and_errors(score, part.loc[known, text].tolist())
                    found = pd.DataFrame(pairs, index=part.index[known], columns=["v", "e"])
                    found = found.reindex(part.index)
                    result[out] = found["v"].astype("float64")
                    errors = found["e"].astype("object")
                    result[f"{out}_error"] = errors.where(errors.notna(), None)
                yield result

    return df.mapInPandas(run, T.StructType(kept + added))


def _size(texts: list[str]) -> Column:
    return sum((F.coalesce(F.length(c), F.lit(0)) for c in texts), F.lit(0))


def _longest_first(frames: Iterator[pd.DataFrame], texts: list[str]) -> Iterator[pd.DataFrame]:
    """The rows again, each frame with at least ``_SORTED`` characters, the last one aside, and in order of length."""
    held, size = [], 0

    def ordered(held: list[pd.DataFrame]) -> pd.DataFrame:
        whole = pd.concat(held, ignore_index=True)
        held.clear()
        return whole.iloc[np.argsort(-_chars(whole, texts), kind="stable")].reset_index(drop=True)

    for frame in frames:
        held.append(frame)
        size += int(_chars(frame, texts).sum()) + len(frame)
        del frame
        if size >= _SORTED:
            size = 0
            yield ordered(held)
    if held:
        yield ordered(held)


def _chars(frame: pd.DataFrame, texts: list[str]) -> np.ndarray:
    return sum(frame[name].str.len().fillna(0).to_numpy(np.int64) for name in texts)


def _batches(texts: pd.DataFrame, rows: int, padded: int) -> Iterator[tuple[int, int]]:
    """Runs of at most ``rows`` rows that take at most ``padded`` characters; one row is always a run."""
    longest = np.zeros(len(texts), np.int64)
    for name in texts.columns:
        longest = np.maximum(longest, texts[name].str.len().fillna(0).to_numpy(np.int64))
    begin = 0
    while begin < len(longest):
        width = np.maximum.accumulate(longest[begin : begin + rows])
        fits = int(np.searchsorted(width * np.arange(1, len(width) + 1), padded, "right"))
        end = begin + max(fits, 1)
        yield begin, end
        begin = end


def balanced(df: DataFrame, texts: list[str], tasks: int) -> DataFrame:
    """The rows in ``tasks`` partitions of like lengths and equal cost, the longest texts first.

    Lengths fall into classes a few percent wide, a few hundred at most.  A class that
    costs more than a task's share is dealt over several tasks.
    """
    size = _size(texts) + 1
    kind = F.floor(F.log2(size.cast("double")) * _CLASSES)
    costs = df.groupBy(kind.alias("kind")).agg(F.sum(size).alias("cost")).orderBy(F.col("kind").desc()).collect()
    total = sum(row["cost"] for row in costs)
    if not total:
        return df
    start, places = 0, []
    for row in costs:
        places += (F.lit(row["kind"]), F.struct(F.lit(start / total).alias("start"), F.lit(row["cost"] / total).alias("share")))
        start += row["cost"]
    # copies of one text lie in different places of their class
    within = F.pmod(F.xxhash64(*texts, F.monotonically_increasing_id()), F.lit(1 << 30)) / float(1 << 30)
    place = F.element_at(F.create_map(*places), kind)
    task = F.least(F.floor((place["start"] + place["share"] * within) * tasks), F.lit(tasks - 1))
    return df.repartitionById(tasks, task.cast("int"))


def batch_score(
    df: DataFrame,
    id_col: str,
    text_col: str,
    scorer: Scorer = length_scorer,
    batch_size: int = DEFAULT_BATCH,
    longest_first: bool = True,
    padded: int = DEFAULT_PADDED,
    tasks: int | None = None,
) -> DataFrame:
    """``(id, score, error)`` for every row of ``df``; the settings are those of ``score_columns``."""
    source = df.select(F.col(id_col), F.col(text_col).alias("_text"))
    scored = score_columns(
        source, {"_text": "score"}, scorer, batch_size, longest_first, True, padded, tasks
    )
    return scored.withColumnRenamed("score_error", "error")


def score_pairs(
    pairs: DataFrame, scorer: Scorer = length_scorer, batch_size: int = DEFAULT_BATCH
) -> DataFrame:
    """Add ``chosen_reward`` and ``rejected_reward``, each with its ``_error``, to prompt pairs.

    A comment that is in many pairs has its prompt scored once: ids and hashes say which prompts
    are the same, the scores are staged and joined back by them.  Without the columns ``chosen`` and
    ``rejected`` each row's prompts are scored where they are.
    """
    sides = ("chosen", "rejected")
    if not set(sides) <= set(pairs.columns):
        prompts = {f"{side}_prompt": f"{side}_reward" for side in sides}
        return score_columns(pairs, prompts, scorer, batch_size)
    hashed = pairs.withColumns({f"_{side}_hash": F.xxhash64(f"{side}_prompt") for side in sides})
    prompt = lambda side: F.struct(
        F.col(side).alias("id"), F.col(f"_{side}_hash").alias("hash"), F.col(f"{side}_prompt").alias("prompt")
    )
    distinct = (
        hashed.select(F.inline(F.array(*[prompt(side) for side in sides])))
        .groupBy("id", "hash")
        .agg(F.first("prompt").alias("prompt"))
    )
    scored = stage(
        score_columns(distinct, {"prompt": "reward"}, scorer, batch_size, drop_texts=True), "rewards"
    )
    for side in sides:
        named = scored.toDF(side, f"_{side}_hash", f"{side}_reward", f"{side}_reward_error")
        hashed = attach(hashed, named, [side, f"_{side}_hash"])
    return hashed.drop(*[f"_{side}_hash" for side in sides])


def score_titles(
    items: DataFrame, generated: DataFrame, scorer: Scorer = length_scorer
) -> DataFrame:
    """Score generated and original titles of model x item results.

    ``items`` holds id, title (and optionally original_title), by, url, time,
    scraped_body and score; ``generated`` holds item_id, model, content, error,
    api_time and total_time.  A failed generation has no title, API time or
    score.  A story that lacks a required field, or that the scorer fails on,
    keeps its title but has no score.  ``error`` says which.

    Original titles are scored once per item and not once per model; an empty
    one is not scored.  Bodies go to the scorer inside the serialised texts
    only; as a column they join the scored rows at the end.
    """
    names = ["title"] + ["original_title"] * ("original_title" in items.columns)
    original = F.col(names[-1])
    scorable = F.coalesce(original != "", F.lit(False)) & _is_valid(original)
    stories = items.select(
        F.col("id").alias("item_id"),
        original.alias("original_title"),
        F.col("score").alias("original_score"),
        "by",
        "url",
        "time",
        "scraped_body",
    )
    originals = score_columns(
        items.select(
            F.col("id").alias("item_id"), F.when(scorable, serialize_with_title(original)).alias("_original")
        ),
        {"_original": "rm_score_original"}, scorer, drop_texts=True,
    ).drop("rm_score_original_error")
    worked = F.col("error").isNull()
    title = F.col("generated_title")
    ready = (
        generated.join(stories, "item_id")
        .withColumn("generated_title", F.when(worked, clean_title(F.col("content"))))
        .withColumn("error", F.coalesce("error", request_problem(score_request(title))))
        .withColumn("_story", F.when(F.col("error").isNull(), serialize_with_title(title)))
        .withColumn("api_time", F.when(title.isNotNull(), F.col("api_time")))
        .withColumnRenamed("content", "full_response")
        .drop("by", "url", "time", "scraped_body")
    )
    scored = score_columns(ready, {"_story": "score"}, scorer, drop_texts=True)
    bodies = items.select(F.col("id").alias("item_id"), "scraped_body")
    return scored.join(originals, "item_id").join(bodies, "item_id").select(
        "item_id",
        "model",
        "generated_title",
        "full_response",
        "original_title",
        "original_score",
        "score",
        "rm_score_original",
        "api_time",
        "total_time",
        F.coalesce("error", "score_error").alias("error"),
        "scraped_body",
    )


def _is_valid(title: Column) -> Column:
    return request_problem(score_request(title)).isNull()
