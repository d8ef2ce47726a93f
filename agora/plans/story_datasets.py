"""Story regression sets, from text posts and from scraped pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agora import fixed_values as fixed
from agora.functions.prompts import title_prompt
from agora.functions.stories import serialize_story
from agora.functions.text import truncate_text, words
from agora.operators import filters
from agora.operators.joins import cross_models
from agora.operators.metrics import with_log_score
from agora.operators.sampling import split_rows, take_first, with_shuffle_key
from agora.operators.training import Tokenizer, filter_chat_length
from agora.sources.tables import union_splits


def build_story_dataset(items: DataFrame, style: str = "plain") -> DataFrame:
    """Live text posts since the start date, with label, text and split.

    One scan with everything computed in place; rows are shuffled by sorting
    on ``with_shuffle_key`` where an order is needed.
    """
    stories = filters.filter_time_range(
        filters.filter_text_stories(items), ge=fixed.REGRESSION_START
    )
    stories = with_log_score(stories).withColumn("serialized", serialize_story(style))
    if "descendants" not in stories.columns:
        stories = stories.withColumn("descendants", F.lit(None).cast("bigint"))
    return split_rows(stories).select(*fixed.STORY_COLUMNS)


def build_scraped_dataset(splits: dict[str, DataFrame] | DataFrame) -> DataFrame:
    """Stories whose page was scraped, newer than the start date, as tagged text."""
    stories = union_splits(splits) if isinstance(splits, dict) else splits
    kept = filters.filter_time_range(filters.filter_scraped_ok(stories), gt=fixed.REGRESSION_START)
    return with_shuffle_key(kept).withColumn("serialized", serialize_story("scraped"))


def replace_title(row, title):
    """The row struct with another title."""
    return row.withField("title", title)


def build_title_rows(
    stories: DataFrame,
    split: str = "train",
    max_items: int = 10,
    min_score: int = 20,
    max_len: int = 8192,
    tokenizer: Tokenizer = words,
) -> DataFrame:
    """Chats that ask for a title, each with the full story it came from."""
    pool = filters.filter_min_score(filters.filter_split(stories, split), min_score)
    chosen = take_first(pool, max_items)
    chats = chosen.select(
        "id",
        title_prompt(F.col("scraped_body")).alias("prompt"),
        F.struct(*chosen.columns).alias("row"),
    )
    return filter_chat_length(chats, max_len, "prompt", tokenizer)


def build_title_requests(
    stories: DataFrame, models: list[str], split: str = "val", max_items: int = 10, min_score: int = 20
) -> DataFrame:
    """``(item_id, model, prompt, original_title, original_score, scraped_body)``: one request per story and model.

    The first ``max_items`` well-scored stories of the split; the chat holds the
    first characters of the body.
    """
    chosen = take_first(filters.filter_min_score(filters.filter_split(stories, split), min_score), max_items)
    title = F.coalesce("original_title", "title") if "original_title" in chosen.columns else F.col("title")
    asked = chosen.select(
        F.col("id").alias("item_id"),
        title_prompt(truncate_text(F.col("scraped_body"))).alias("prompt"),
        title.alias("original_title"),
        F.col("score").alias("original_score"),
        "scraped_body",
    )
    return cross_models(asked, models)
