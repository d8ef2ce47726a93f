"""Prompt texts and chats as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from agora import fixed_values as fixed
from agora.functions.stories import serialize_story

XML_ESCAPES = (
    ("&", "&amp;"),
    ('"', "&quot;"),
    ("'", "&apos;"),
    ("<", "&lt;"),
    (">", "&gt;"),
)


def xml_text(value: Column) -> Column:
    """Escaped text; null stays null."""
    out = value
    for char, code in XML_ESCAPES:
        out = F.replace(out, F.lit(char), F.lit(code))
    return out


def element(tag: str, *content: Column) -> Column:
    return F.concat(F.lit(f"<{tag}>"), *content, F.lit(f"</{tag}>"))


def author_and_text(author: Column, text: Column) -> Column:
    """A comment's content; takes escaped values."""
    return F.concat(element("author", author), element("text", text))


def story_content(title: Column, url: Column, text: Column) -> Column:
    """A story's content; takes escaped values, url and text only when there are any."""
    def leaf(tag, value):
        return F.when(value.isNull(), F.lit("")).otherwise(element(tag, value))

    return F.concat(element("title", title), leaf("url", url), leaf("text", text))


def comment_xml(version: str, comment: Column, chain: Column, story: Column) -> Column:
    """The rating prompt around the given contents.

    ``comment`` and ``story`` are contents as made above, ``chain`` an array of
    ancestors' contents, the nearest first.
    """
    ancestors = F.transform(chain, lambda a: element("item", a))
    above = element("parent_chain", F.array_join(ancestors, ""))
    told = element("story", story)
    if version == "v1":
        ask = element("instructions", xml_text(F.lit(fixed.COMMENT_INSTRUCTIONS)))
        return F.concat(ask, element("comment", comment, above), told)
    if version == "v2":
        return F.concat(told, above, element("comment", comment))
    raise ValueError(f"unknown prompt version {version!r}")


def _message(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def title_prompt(body: Column) -> Column:
    """Chat asking for a title of the body."""
    return F.array(
        _message("system", F.lit(fixed.TITLE_SYSTEM)),
        _message("user", F.concat(F.lit(fixed.TITLE_REQUEST), F.coalesce(body, F.lit("None")))),
    )


def match_prompt(body: Column, title: Column) -> Column:
    """Chat asking whether the body supports the title."""
    content = F.concat(
        F.lit("<article>"), F.coalesce(body, F.lit("None")),
        F.lit("</article>\n<proposed_title>"), F.coalesce(title, F.lit("None")),
        F.lit("</proposed_title>"),
    )
    return F.array(_message("system", F.lit(fixed.MATCH_SYSTEM)), _message("user", content))


def reasoning_prompt() -> Column:
    """The tagged story inside the think-then-answer request."""
    return F.concat(F.lit(fixed.REASONING_REQUEST), serialize_story("scraped"), F.lit("\n"))


def render_message(message: Column) -> Column:
    """One message in the default chat layout; null where role or content is."""
    opening, closing = F.lit("<|im_start|>"), F.lit("<|im_end|>\n")
    return F.concat(opening, message["role"], F.lit("\n"), message["content"], closing)


def render_chat(chat: Column) -> Column:
    """Default chat layout, with the opening of the reply appended.

    A model's own layout can be used instead wherever a ``render`` argument
    is offered.
    """
    return F.concat(F.array_join(F.transform(chat, render_message), ""), F.lit("<|im_start|>assistant\n"))
