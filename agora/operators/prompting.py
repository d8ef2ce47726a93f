"""Rating prompts for comments.

A prompt holds the texts of its story, its comment and all ancestors, so the prompts of a whole
table are many times the table.  ``PromptSteps`` makes them a part at a time: who is quoted is
found once, on ids, and each step moves the texts of its own threads alone.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agora.functions.prompts import author_and_text, comment_xml, story_content, xml_text
from agora.operators.forest import ancestor_steps
from agora.operators.joins import attach, keep_in
from agora.sources.staging import stage, stage_each

# Places of a prompt's parts; ancestors have 0 and up.
_STORY, _SELF = -2, -1
_FIELDS = ("by", "text", "title", "url")
#: Prompts of a table are made in at most so many steps, each of which quotes about so many posts.
STEPS = 32
STEP_POSTS = 250_000


def quoted_posts(ids: DataFrame, items: DataFrame) -> DataFrame:
    """``(id, place, post)``, staged: which posts a comment's prompt quotes, and where."""
    wanted = stage(keep_in(items, "id", ids).select("id", "top_level_parent"), "wanted")
    others = F.array(
        F.struct(F.lit(_STORY).alias("place"), F.col("top_level_parent").alias("post")),
        F.struct(F.lit(_SELF).alias("place"), F.col("id").alias("post")),
    )
    above = ancestor_steps(wanted, items).select("id", F.col("depth").alias("place"), F.col("ancestor").alias("post"))
    return stage(wanted.select("id", F.inline(others)).unionByName(above), "steps")


def _content() -> Column:
    """A post's content in its place; takes escaped values."""
    def or_empty(name: str):
        return F.coalesce(F.col(name), F.lit(""))

    return F.when(
        F.col("place") == _STORY, story_content(or_empty("title"), F.col("url"), F.col("text"))
    ).otherwise(author_and_text(or_empty("by"), or_empty("text")))


def _contents(quoted: DataFrame, items: DataFrame) -> DataFrame:
    """``(id, place, content)`` from items that hold their texts; each is escaped once."""
    posts = keep_in(items.select("id", *_FIELDS), "id", quoted.select("post").distinct())
    posts = posts.select(F.col("id").alias("post"), *[xml_text(F.col(c)).alias(c) for c in _FIELDS])
    # unlike a plain join, this one shuffles the posts anew and so leaves hot posts open to being split
    return attach(quoted, posts, ["post"], "inner").select("id", "place", _content().alias("content"))


def _read_contents(quoted: DataFrame, items: DataFrame, reader) -> DataFrame:
    """The same where texts are stored apart: only their keys meet the posts, the texts meet them last."""
    kept = ("by", "title", "url", "text_key")
    posts = keep_in(items.select("id", *kept), "id", quoted.select("post").distinct()).withColumnRenamed("id", "post")
    placed = attach(quoted, posts, ["post"], "inner")
    # the reader takes the id of the post, whose text it is
    placed = stage(placed.select(F.col("id").alias("asked"), "place", F.col("post").alias("id"), *kept), "placed")
    told = reader.only(placed).repeated(placed).withColumns({c: xml_text(F.col(c)) for c in _FIELDS})
    return told.select(F.col("asked").alias("id"), "place", _content().alias("content"))


def _parts(contents: DataFrame) -> DataFrame:
    return contents.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("place", "content"))).alias("parts"))


def prompt_parts(ids: DataFrame, items: DataFrame) -> DataFrame:
    """``(id, parts)``: the story, the comment and its ancestors as XML contents.

    All a prompt needs are posts looked up by id, so they are looked up
    together: one join of (comment, place, post id) rows with the posts, and
    one grouping by comment.  For a sample of comments, posts nobody quotes are
    dropped where they are stored.  The others are escaped once each, however
    many prompts quote them.  A group is as long as its comment is deep, and
    the side that may be hot (a story quoted by all its comments) carries ids
    only.
    """
    return _parts(_contents(quoted_posts(ids, items), items))


def _prompts(parts: DataFrame, versions: tuple[str, ...]) -> DataFrame:
    def part(place: int):
        found = F.filter("parts", lambda p: p["place"] == place)
        return F.coalesce(F.get(found, F.lit(0))["content"], F.lit(""))

    chain = F.transform(
        F.filter("parts", lambda p: p["place"] >= 0), lambda p: p["content"]
    )
    made = [
        comment_xml(v, part(_SELF), chain, part(_STORY)).alias(f"prompt_{v}") for v in versions
    ]
    return parts.select("id", *made)


def comment_prompt(
    ids: DataFrame, items: DataFrame, versions: tuple[str, ...] = ("v1",)
) -> DataFrame:
    """``id`` plus ``prompt_<version>`` for every requested version.

    Versions share the lookup of ancestors and story.
    """
    return _prompts(prompt_parts(ids, items), versions)


def dealt_by_thread(rows: DataFrame, key: str = "id", thread: str = "top_level_parent") -> DataFrame:
    """Add ``share``, one of ``STEPS``: threads stay whole, so that few steps read the same texts.

    A thread with more rows than a share should have is dealt out by ``key``.
    """
    named = rows.withColumn("_thread", F.coalesce(thread, key))
    most = math.ceil(rows.count() / STEPS)
    large = stage(named.groupBy("_thread").agg(F.count("*").alias("_rows")).where(F.col("_rows") > most), "large-threads")
    by = F.when(F.col("_rows").isNull(), F.xxhash64("_thread")).otherwise(F.xxhash64(key))
    return attach(named, large, ["_thread"]).withColumn("share", F.pmod(by, F.lit(STEPS)).cast("int")).drop("_thread", "_rows")


class PromptSteps:
    """The prompts of ``dealt`` comments in ``count`` steps.

    ``dealt`` (id, share) says by which of ``STEPS`` shares a comment's prompt is wanted; it may be wanted by
    several.  Where the items' texts are stored apart, ``reader`` adds them.
    """

    def __init__(self, dealt: DataFrame, items: DataFrame, versions: tuple[str, ...] = ("v1",), reader=None):
        self.items, self.versions, self.reader = items, versions, reader
        quoted = quoted_posts(dealt.select("id").distinct(), items)
        self.count = max(1, min(STEPS, math.ceil(quoted.count() / STEP_POSTS)))
        if self.count > 1:
            steps = dealt.select("id", self.step().alias("step")).distinct()
            # as many partitions as steps, so that a step reads its own rows
            quoted = stage(quoted.join(steps, "id").repartitionById(self.count, F.col("step")), "steps")
        self.quoted = quoted

    def step(self) -> Column:
        """The step of a row with a ``share``."""
        return F.pmod("share", F.lit(self.count))

    def __call__(self, step: int) -> DataFrame:
        """``id`` plus ``prompt_<version>`` of one step."""
        quoted = self.quoted
        if self.count > 1:
            quoted = quoted.where(F.col("step") == step).drop("step")
        if self.reader is None:
            contents = _contents(quoted, self.items)
        else:
            contents = _read_contents(quoted, self.items, self.reader)
        return _prompts(_parts(contents), self.versions)

    def each(self, make: Callable[[DataFrame], DataFrame], label: str) -> DataFrame:
        """``make`` of each step's prompts, staged as one table."""
        return stage_each(self.items.sparkSession, self.count, lambda i: make(self(i)), label)


def prompt_steps(
    ids: DataFrame, items: DataFrame, versions: tuple[str, ...] = ("v1",), reader=None
) -> PromptSteps:
    """The prompts of the comments, once per id."""
    asked = keep_in(items.select("id", "top_level_parent"), "id", ids)
    dealt = dealt_by_thread(asked.groupBy("id").agg(F.min("top_level_parent").alias("top_level_parent")))
    return PromptSteps(dealt, items, versions, reader)
