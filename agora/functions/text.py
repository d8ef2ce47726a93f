"""Text expressions.

Everything here stays inside the JVM except ``unescape_entities``.
"""

from __future__ import annotations

import functools
import html

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from agora import fixed_values as fixed

# The characters Python's str.strip removes.
WHITESPACE = "".join(map(chr, [*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680,
                               *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))

@F.pandas_udf(T.StringType())
def _unescape(texts: pd.Series) -> pd.Series:
    return texts.map(html.unescape, na_action="ignore")


def strip(text: Column) -> Column:
    """Remove leading and trailing whitespace of every kind."""
    return F.btrim(text, F.lit(WHITESPACE))


def unescape_entities(text: Column) -> Column:
    """Undo HTML escapes, null stays null.

    The full entity table, with its entities that lack a semicolon, is only at
    hand in Python.  Texts go there in Arrow batches, and only those that hold
    an ampersand; of the others the UDF sees a null.
    """
    escaped = F.when(F.contains(text, F.lit("&")), text)
    return F.coalesce(_unescape(escaped), text)


def paragraphs(text: Column) -> Column:
    return F.replace(text, F.lit("<p>"), F.lit("\n\n"))


def unescape_html(text: Column) -> Column:
    """Entities, then paragraph marks, then links reduced to their address."""
    return F.regexp_replace(paragraphs(unescape_entities(text)), fixed.ANCHOR_PATTERN, "$1")


def is_longer_than(text: Column, chars: int) -> Column:
    """Whether the text has more than ``chars`` characters once it is cleaned.

    Cleaning leaves everything before the first ``&`` or ``<`` as it is, so a
    long enough beginning without them settles most texts without cleaning.
    """
    clear = F.regexp_like(text, F.lit(rf"\A[^&<]{{{chars + 1}}}"))
    cleaned = unescape_html(F.when(~clear, text))
    return clear | (F.char_length(cleaned) > chars)


def truncate_text(text: Column, chars: int = fixed.MAX_BODY_CHARS) -> Column:
    return F.substring(F.coalesce(text, F.lit("")), 1, chars)


def or_none(value: Column) -> Column:
    """Text of a value, with the word ``None`` for null."""
    return F.coalesce(value.cast("string"), F.lit("None"))


def count_of(text: Column, piece: str) -> Column:
    """Non-overlapping occurrences of ``piece``."""
    gone = F.replace(text, F.lit(piece), F.lit(""))
    return ((F.length(text) - F.length(gone)) / len(piece)).cast("int")


def words(text: Column) -> Column:
    """Default tokenizer: whitespace-separated words as an array."""
    return F.filter(F.split(text, r"\s+"), lambda w: w != "")


@functools.cache
def _digit_class() -> str:
    # Digits such as superscripts that are not decimals, by rule.
    extra = [c for c in map(chr, range(0x110000)) if c.isdigit() and not c.isdecimal()]
    return r"\A[\p{Nd}" + "".join(extra) + r"]+\z"


def is_digits(text: Column) -> Column:
    return F.regexp_like(text, F.lit(_digit_class()))


def parse_number(text: Column) -> Column:
    """A float literal as a double, else the first run of digits, else null."""
    digits = r"\d+(?:_\d+)*"
    literal = (
        rf"(?i)\A[+-]?(?:(?:{digits}\.?(?:{digits})?|\.{digits})(?:e[+-]?{digits})?"
        r"|inf|infinity|nan)\z"
    )
    plain = F.replace(text, F.lit("_"), F.lit("")).try_cast("double")
    first = F.regexp_extract(text, r"\d+", 0).try_cast("double")
    return F.when(F.regexp_like(text, F.lit(literal)), plain).otherwise(first)


def parse_reasoning(text: Column) -> dict[str, Column]:
    """Columns read from a think/answer text.

    ``predictions`` is NaN where there is no answer, so that metrics can tell
    it from a missing row.
    """
    thought = F.when(
        F.regexp_like(text, F.lit(fixed.THINK_PATTERN)),
        strip(F.regexp_extract(text, fixed.THINK_PATTERN, 1)),
    )
    answer = F.when(
        F.regexp_like(text, F.lit(fixed.ANSWER_PATTERN)),
        parse_number(strip(F.regexp_extract(text, fixed.ANSWER_PATTERN, 1))),
    )
    return {
        "reasoning": thought,
        "predictions": F.coalesce(answer, F.lit(float("nan"))),
        "has_reasoning": F.coalesce(thought.isNotNull(), F.lit(False)),
        "has_answer": F.coalesce(answer.isNotNull(), F.lit(False)),
    }


def extract_tagged_answer(text: Column) -> Column:
    """Text after the last opening answer tag, up to the first closing one."""
    tail = F.split_part(text, F.lit("<answer>"), F.lit(-1))
    return strip(F.split_part(tail, F.lit("</answer>"), F.lit(1)))


def extract_hash_answer(text: Column) -> Column:
    """The piece after the first ``####``, null when there is none."""
    return F.when(
        F.contains(text, F.lit("####")),
        strip(F.split_part(text, F.lit("####"), F.lit(2))),
    )


def clean_title(text: Column) -> Column:
    """Strip, drop one matching pair of outer quotes, strip again; null gives ''."""
    bare = strip(F.coalesce(text, F.lit("")))
    quoted = (bare.startswith('"') & bare.endswith('"')) | (
        bare.startswith("'") & bare.endswith("'")
    )
    inner = strip(F.substring(bare, F.lit(2), F.length(bare) - 2))
    return F.when(quoted, inner).otherwise(bare)


def parse_flag(text: Column) -> Column:
    """1 when the text begins with t or T, else 0."""
    return F.when(F.lower(F.substring(text, 1, 1)) == "t", 1).otherwise(0)


def is_clean_flag(text: Column) -> Column:
    return text.isin("True", "False")
