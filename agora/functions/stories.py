"""Story texts as models read them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from agora import fixed_values as fixed
from agora import schemas
from agora.functions.text import or_none, paragraphs, unescape_entities


def day(time: Column, pattern: str = fixed.DAY_FORMAT) -> Column:
    return F.date_format(time, pattern)


def iso_time(time: Column) -> Column:
    """ISO text of a time; the fraction is left out when it is zero."""
    whole = F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss")
    fraction = F.date_format(time, ".SSSSSS")
    return F.when(fraction == ".000000", whole).otherwise(F.concat(whole, fraction))


def parse_iso_time(text: Column) -> Column:
    return F.to_timestamp_ntz(text)


def score_request(title: Column) -> Column:
    """What a scorer is told about a story, with its time as ISO text."""
    return F.struct(
        title.alias("title"),
        F.col("by"),
        iso_time(F.col("time")).alias("time"),
        F.col("scraped_body"),
        F.col("url"),
    )


def request_problem(request: Column) -> Column:
    """Which required field a request lacks, null for a valid one; url may be missing."""
    required = [f.name for f in schemas.SCORE_REQUEST.fields if not f.nullable]
    return F.coalesce(
        *[F.when(request[name].isNull(), F.lit(f"{name} is missing")) for name in required]
    )


def _plain() -> Column:
    return F.concat(
        F.lit("\n"), or_none(F.col("title")),
        F.lit("\n"), or_none(F.col("by")), F.lit(", "), or_none(day(F.col("time"))),
        F.lit("\n\n"), or_none(paragraphs(unescape_entities(F.col("text")))), F.lit("\n"),
    )


def _by_line() -> Column:
    when = day(F.col("time"), fixed.LONG_DATE_FORMAT)
    return F.concat(
        F.lit("\n"), or_none(F.col("title")),
        F.lit("\nby "), or_none(F.col("by")), F.lit(", "), or_none(when),
        F.lit("\n\n"), or_none(paragraphs(unescape_entities(F.col("text")))), F.lit("\n"),
    )


def _tagged(title: Column | None = None) -> Column:
    title = F.col("title") if title is None else title
    return F.concat(
        F.lit("<submitter>"), or_none(F.col("by")),
        F.lit("</submitter>\n<url>"), or_none(F.col("url")),
        F.lit("</url>\n<date>"), or_none(day(F.col("time"))),
        F.lit("</date>\n\n<body>"), or_none(F.col("scraped_body")),
        F.lit("</body>\n<title>"), or_none(title), F.lit("</title>"),
    )


def _address() -> Column:
    return F.concat(F.lit("URL: "), or_none(F.col("url")))


STYLES = {"plain": _plain, "by": _by_line, "scraped": _tagged, "url": _address}


def serialize_story(style: str = "plain") -> Column:
    """Story text in one of the layouts ``plain``, ``by``, ``scraped`` and ``url``.

    Reads the columns title, by, time, text, url and scraped_body as the layout
    needs them; nulls print as ``None``.
    """
    return STYLES[style]()


def serialize_with_title(title: Column) -> Column:
    """The ``scraped`` layout with another title."""
    return _tagged(title)


def with_link(id_col: Column, prefix: str = fixed.LINK_PREFIX) -> Column:
    return F.concat(F.lit(prefix), id_col.cast("string"))
