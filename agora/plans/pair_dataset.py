"""Preference pairs from a full item table, with prompts and splits."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agora import fixed_values as fixed
from agora.functions.text import is_longer_than
from agora.operators import forest
from agora.operators.filters import filter_min_score, filter_sibling_band, filter_type
from agora.operators.joins import attach, exclude_in, keep_in
from agora.operators.pairs import preference_pairs
from agora.operators.prompting import PromptSteps, comment_prompt, dealt_by_thread
from agora.operators.sampling import sample_n, sample_per_split, split_by_group
from agora.sources.staging import stage, stage_each, stage_steps

#: Column that identifies a pair in the deterministic samples.
PAIR_KEY = "rejected"


def _long_enough() -> Column:
    return is_longer_than(F.col("text"), fixed.MIN_TEXT_CHARS).alias("long_enough")


def candidate_comments(items: DataFrame, min_score: int = fixed.MIN_ROOT_SCORE) -> DataFrame:
    """Comments below well-scored roots with rank, sibling count and a text check.

    Text is looked at during the scan and left there; only ids and numbers move
    on.  The sibling count and rank look at all comments, before any filter.  Where
    texts are stored apart, their keys move on instead.
    """
    comments = filter_type(items, "comment").select(
        "id",
        "parent",
        "top_level_parent",
        "time",
        _long_enough() if "text" in items.columns else F.col("text_key"),
    )
    roots = filter_min_score(items, min_score).select("id")
    sizes = (
        filter_type(items, "comment")
        .groupBy("parent")
        .agg(F.count("id").alias("siblings_count"))
    )
    kept = attach(keep_in(comments, "top_level_parent", roots), sizes, ["parent"])
    return forest.sibling_rank(kept, items)


def pair_candidates(items: DataFrame, reader=None) -> DataFrame:
    """Comments fit for pairing, staged.

    Where texts are stored apart, ``reader`` reads those of comments that are fit but for their text.
    """
    candidates = stage(candidate_comments(items), "candidates")
    closed = forest.thread_closure(candidates)
    usable = filter_sibling_band(closed).where(F.col("sibling_rank") > 0)
    if reader is None:
        return stage(usable.where("long_enough"), "usable")
    kept = [F.col(c) if c != "text_key" else _long_enough() for c in usable.columns]
    usable = stage(usable, "fit-but-for-text")
    parts = reader.only(usable).steps(usable)
    return stage_steps([part.select(*kept).where("long_enough") for part in parts], "usable")


def split_pairs(
    comments: DataFrame, window_seconds: int = fixed.PAIR_WINDOW_SECONDS
) -> DataFrame:
    """Pairs with their split; a thread never straddles splits."""
    return split_by_group(preference_pairs(comments, window_seconds), "top_level_parent")


def _named_prompts(prompts: DataFrame, side: str, versions: tuple[str, ...]) -> DataFrame:
    return prompts.select(
        F.col("id").alias(side),
        *[F.col(f"prompt_{v}").alias(f"{side}_prompt_{v}") for v in versions],
    )


def attach_prompts(
    pairs: DataFrame, prompts: DataFrame, versions: tuple[str, ...]
) -> DataFrame:
    """Add ``chosen_prompt_<v>`` and ``rejected_prompt_<v>`` from a prompt table."""
    for side in ("chosen", "rejected"):
        pairs = pairs.join(_named_prompts(prompts, side, versions), side, "left")
    return pairs


def members(pairs: DataFrame) -> DataFrame:
    """Ids of all comments in the pairs."""
    return pairs.select(F.explode(F.array("chosen", "rejected")).alias("id")).distinct()


def with_prompts(
    pairs: DataFrame, items: DataFrame, versions: tuple[str, ...] = ("v1", "v2")
) -> DataFrame:
    """Pairs with their prompts; each comment's prompt is built once."""
    prompts = stage(comment_prompt(members(pairs), items, versions), "prompts")
    return attach_prompts(pairs, prompts, versions)


def each_with_prompts(
    pairs: DataFrame, items: DataFrame, make: Callable[[DataFrame], DataFrame], label: str,
    versions: tuple[str, ...] = ("v1", "v2"), reader=None,
) -> DataFrame:
    """``make`` of staged pairs with their prompts, in steps and staged as one table.

    A step has the pairs of whole threads, of a very large one those of whole groups, and builds
    each comment's prompt once.
    """
    dealt = stage(dealt_by_thread(pairs, "chosen"), "dealt-pairs")
    wanted = dealt.select(F.explode(F.array("chosen", "rejected")).alias("id"), "share").distinct()
    prompts = PromptSteps(wanted, items, versions, reader)

    def part(step: int) -> DataFrame:
        own = dealt.where(prompts.step() == step).drop("share")
        return make(attach_prompts(own, stage(prompts(step), "prompts"), versions))

    return stage_each(items.sparkSession, prompts.count, part, label)


@dataclass
class PairDataset:
    pairs: DataFrame      # every pair with its split
    sample: DataFrame     # sampled pairs with prompts
    splits: DataFrame     # the published rows of each split
    held_out: DataFrame   # best-ranked comments not seen in training


def build_pair_dataset(
    items: DataFrame,
    window_seconds: int = fixed.PAIR_WINDOW_SECONDS,
    sample_size: int = fixed.PAIR_SAMPLE_SIZE,
    split_sizes: dict[str, int] | None = None,
    versions: tuple[str, ...] = ("v1", "v2"),
) -> PairDataset:
    """From items to published pairs and held-out comments."""
    comments = pair_candidates(items)
    pairs = stage(split_pairs(comments, window_seconds), "pairs")
    sampled = sample_n(pairs, sample_size, PAIR_KEY).withColumn(
        "split", F.when(F.col("split") == "val", "validation").otherwise(F.col("split"))
    )
    published = sample_per_split(sampled, split_sizes or fixed.PAIR_SPLIT_SIZES, PAIR_KEY)
    train = published.where(F.col("split") == "train")
    best = comments.where(F.col("sibling_rank") == 1)
    held_out = exclude_in(best, "id", train.select("chosen"), train.select("rejected"))
    # A comment needs a prompt as part of a pair or because it is held out; all
    # of them are built in one go, which walks the threads once.
    asked = members(sampled).unionByName(held_out.select("id")).distinct()
    prompts = stage(comment_prompt(asked, items, versions), "prompts")
    first = prompts.select("id", F.col(f"prompt_{versions[0]}").alias("prompt"))
    return PairDataset(
        pairs,
        attach_prompts(sampled, prompts, versions),
        attach_prompts(published, prompts, versions),
        held_out.join(first, "id"),
    )
