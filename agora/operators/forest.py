"""Reply-forest operators.

Levels.  Every open comment keeps a pointer to an ancestor and jumps over that
ancestor's own pointer in each round, so ``r`` rounds cover ``2**r`` levels: five
rounds for 24 levels.  Only rows that others point at go into the next round: first the
comments with replies, then those with replies of replies, and so on.  All others wait
and are joined once, in the end, to what their pointer has become; rows that are done do
not move again.  For chains of any length the rows are ranked by sparse ruling sets: one id in eight is a
ruler, pointers stop at rulers, the rulers alone are ranked over their longer pointers,
and the rest is joined to its ruler once.  The work grows with the rows, and only an
eighth of it with the logarithm of the depth.

Ancestors.  A few asked comments walk upwards: each round looks up the posts that are
reached now, whatever else their threads hold.  What is still open after ``WALK_ROUNDS``
rounds, and everything where a large part of all posts is asked for, climbs by tables of
jumps over 1, 2, 4... posts of the threads concerned.  Results are rows of (id, depth,
ancestor), as many as there are ancestors.

Only ids move during the rounds, never text.  Each join streams the side that may be hot
(many replies below one ancestor) against one that is unique per id; results are staged
so that lineage stays short.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agora import fixed_values as fixed
from agora.functions.text import unescape_html
from agora.operators.joins import attach, keep_in
from agora.sources.staging import discard, stage, stage_steps

#: One id in so many is a ruler where chains may have any length.
RULERS = 8
#: Asked comments walk so many posts up before their whole threads are looked at.
WALK_ROUNDS = 32
#: They walk if they are at most one in so many of all posts.
WALK_SHARE = 16
#: Chains of so many posts are looked at for cycles.
_UNCHECKED = 64

# --- ranks and sibling counts ----------------------------------------------


def _ranked(kids: Column) -> Column:
    """(id, rank) entries of one list; an id listed twice keeps its last place."""
    plain = F.transform(kids, lambda k, i: F.struct(k.alias("id"), (i + 1).alias("rank")))
    # in order of id and rank, the last one of each id; the sorted list is an
    # argument of the inner function so that it is sorted once
    last = F.transform(
        F.array(F.array_sort(plain)),
        lambda ordered: F.filter(
            ordered, lambda k, i: ~F.get(ordered, i + 1)["id"].eqNullSafe(k["id"])
        ),
    )
    repeats = F.size(F.array_distinct(kids)) < F.size(kids)
    return F.when(repeats, F.element_at(last, 1)).otherwise(plain)


def kid_ranks(items: DataFrame) -> DataFrame:
    """``(id, sibling_rank)`` from the display order kept in ``kids``.

    An id listed more than once takes its last mention, the one under the
    highest parent id.  Repeats within a list are settled in the row, which
    leaves an aggregate over plain numbers that hashes instead of sorting.
    """
    mentions = items.where(F.col("kids").isNotNull()).select(
        F.col("id").alias("owner"), F.inline(_ranked(F.col("kids")))
    ).toDF("owner", "id", "rank")
    return mentions.groupBy("id").agg(F.max_by("rank", "owner").alias("sibling_rank"))


def sibling_rank(df: DataFrame, items: DataFrame) -> DataFrame:
    """Add ``sibling_rank``: 1-based place among the parent's kids, -1 if unlisted."""
    return df.join(kid_ranks(items), "id", "left").withColumn(
        "sibling_rank", F.coalesce("sibling_rank", F.lit(-1))
    )


def rank_stats(items: DataFrame) -> DataFrame:
    """Largest rank and number of ranked ids."""
    return kid_ranks(items).agg(
        F.max("sibling_rank").alias("max_rank"), F.count("id").alias("ranked_ids")
    )


def siblings_count(comments: DataFrame) -> DataFrame:
    """Add the number of comments under the same parent, itself included.

    Counted by a partial aggregate and joined back.  A window would be
    shorter, but it holds a parent's whole group in one task, and one parent
    may own a large part of the table.
    """
    sizes = comments.groupBy("parent").agg(F.count("id").alias("siblings_count"))
    return attach(comments, sizes, ["parent"])


# --- levels --------------------------------------------------------------------


def _is_ruler(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(RULERS)) == 0


def _over_tip(rows: DataFrame, tips: DataFrame, limit: int) -> DataFrame:
    """Each of ``rows`` moved over what its tip says; without a word of the tip it leads nowhere.

    ``tips`` may hold more rows than those pointed at.  Both have id, tip, level and hops.
    """
    said = tips.toDF("tip", "tip_tip", "tip_level", "tip_hops")
    settled = F.col("tip_level").isNotNull()
    total = F.col("hops") + F.col("tip_level")
    far = F.col("hops") + F.coalesce("tip_hops", F.lit(0))
    # unlike a plain join, this one leaves hot tips open to being split
    return attach(rows, said, ["tip"]).select(
        "id",
        F.when(~settled & (far <= limit), F.col("tip_tip")).alias("tip"),
        F.when(total <= limit, total).alias("level"),
        far.alias("hops"),
    )


def _climb(nodes: DataFrame, label: str, limit: int, stop: Column, rounds: int = 0) -> DataFrame:
    """Double the pointers of staged ``nodes`` (id, tip, level, hops) until none is open; the same columns.

    A row is closed when its level is known, when ``tip`` is null (it leads nowhere) or when
    ``stop`` holds for its tip.  Chains longer than ``limit`` lead nowhere.  Only what is pointed
    at moves on to the next round; all other rows wait, and are moved over their tip in the end.
    """
    is_open = F.col("level").isNull() & F.col("tip").isNotNull() & ~stop
    still, closed = nodes.where(is_open), nodes.where(~is_open)
    if still.isEmpty():
        return nodes
    met = stage(keep_in(nodes, "id", still.select("tip").distinct()), f"{label}-met")
    doubled = _over_tip(met.where(is_open), met, limit).unionByName(met.where(~is_open))
    final = _climb(stage(doubled, label), label, limit, stop, rounds + 1)
    found = _over_tip(still, final, limit).unionByName(closed)
    return stage(found, label) if rounds > 4 else found


def _rank_by_rulers(nodes: DataFrame, label: str, limit: int) -> DataFrame:
    """Levels of ``nodes`` with chains of any length, by a sparse ruling set."""
    ruled = F.col("level").isNull() & F.col("tip").isNotNull()
    reached = stage(_climb(nodes, label, limit, stop=_is_ruler(F.col("tip"))), f"{label}-segments")
    rulers = stage(reached.where(_is_ruler(F.col("id"))), f"{label}-rulers")
    ranked = stage(_climb(rulers, f"{label}-rulers", limit, stop=F.lit(False)), f"{label}-ranked")
    return _over_tip(reached.where(ruled), ranked, limit).unionByName(reached.where(~ruled))


def reply_levels(comments: DataFrame, max_level: int | None = fixed.MAX_NESTED_LEVEL) -> DataFrame:
    """``(id, nested_level)``: 0 for direct replies, parent's level + 1 below.

    Only parents inside ``comments`` count.  -1 marks comments that are deeper
    than ``max_level`` (None: any depth) or do not connect to a direct reply.
    """
    top = F.coalesce(F.col("parent") == F.col("top_level_parent"), F.lit(False))
    nodes = stage(
        comments.select(
            "id",
            F.when(~top, F.col("parent")).alias("tip"),
            F.when(top, 0).cast("long").alias("level"),
            F.lit(1).cast("long").alias("hops"),
        ),
        "levels",
    )
    if max_level is None:
        ranked = _rank_by_rulers(nodes, "levels", limit=nodes.count())
    else:
        ranked = _climb(nodes, "levels", limit=max_level, stop=F.lit(False))
    return ranked.select("id", F.coalesce("level", F.lit(-1)).cast("int").alias("nested_level"))


def nested_level(comments: DataFrame, max_level: int = fixed.MAX_NESTED_LEVEL) -> DataFrame:
    """Add ``nested_level`` to the comments."""
    return comments.join(reply_levels(comments, max_level), "id", "left")


def thread_closure(
    comments: DataFrame,
    max_rank: int = fixed.CLOSURE_MAX_RANK,
    rounds: int = fixed.CLOSURE_ROUNDS,
) -> DataFrame:
    """Comments that hang on a story by a chain of well-ranked comments.

    Starting from well-ranked direct replies, ``rounds`` rounds add the
    well-ranked replies of what is already kept.  That is the set whose level
    among the well-ranked comments alone is at most ``rounds``.  Rank -1
    counts as well ranked here.
    """
    ranked = comments.where(F.col("sibling_rank") <= max_rank)
    levels = reply_levels(ranked, max_level=rounds)
    return ranked.join(levels.where(F.col("nested_level") >= 0), "id", "left_semi")


# --- ancestors ---------------------------------------------------------------


def _below_story() -> Column:
    """Whether a post answers another one than its story."""
    return F.col("parent").isNotNull() & ~F.col("parent").eqNullSafe(F.col("top_level_parent"))


def _jumps(items: DataFrame) -> DataFrame:
    """``(ancestor, next)``: posts below a story and the post above them, unless that is the story."""
    return items.where(_below_story()).select(F.col("id").alias("ancestor"), F.col("parent").alias("next"))


def _one_up(rows: DataFrame, jumps: DataFrame, by: int) -> DataFrame:
    """Rows of (id, depth, ancestor) moved ``by`` posts up; those that end before are gone."""
    # unlike a plain join, this one leaves hot ancestors open to being split
    return attach(rows, jumps, ["ancestor"], "inner").select(
        "id", (F.col("depth") + by).alias("depth"), F.col("next").alias("ancestor")
    )


def _walked(start: DataFrame, items: DataFrame, rounds: int) -> tuple[list[DataFrame], DataFrame]:
    """Walk up one post a round; what was found and the rows that are still on their way."""
    found, still = [], start
    for _ in range(rounds):
        if still.isEmpty():
            break
        found.append(still)
        met = keep_in(_jumps(items), "ancestor", still.select("ancestor").distinct())
        still = stage(_one_up(still, met, 1), "walk")
    return found, still


def _check_ends(jumps: DataFrame) -> None:
    """Raise if some chain of jumps never ends."""
    edges = jumps.select(F.col("ancestor").alias("id"), F.col("next").alias("tip"))
    unknown, known = F.lit(None).cast("long"), F.lit(0).cast("long")
    below = edges.select("id", "tip", unknown.alias("level"), F.lit(1).cast("long").alias("hops"))
    ids = edges.select("id")
    tops = edges.select(F.col("tip").alias("id")).distinct().join(ids, "id", "left_anti")
    tops = tops.select("id", unknown.alias("tip"), known.alias("level"), known.alias("hops"))
    ranked = _rank_by_rulers(stage(below.unionByName(tops), "ranks"), "ranks", limit=jumps.count())
    if not ranked.where("level is null").isEmpty():
        raise ValueError("a reply chain does not end; parents form a cycle")


def _climbed(start: DataFrame, threads: DataFrame) -> DataFrame:
    """``start`` and all ancestors above, by jumps that double in length until none is left.

    ``threads`` are the posts of all threads concerned.  Only posts that are answered are jumped from.
    """
    edges = _jumps(threads)
    answered = edges.select("next").unionByName(start.select(F.col("ancestor").alias("next"))).distinct()
    jumps = stage(keep_in(edges, "ancestor", answered), "jumps")
    rows, length = start, 1
    while not jumps.isEmpty():
        if length == _UNCHECKED:
            _check_ends(jumps)
        longer = stage(rows.unionByName(_one_up(rows, jumps, length)), "ancestors")
        if rows is not start:
            discard(rows)
        rows = longer
        further = stage(
            jumps.join(jumps.toDF("next", "after"), "next").select("ancestor", F.col("after").alias("next")), "jumps"
        )
        discard(jumps)
        jumps, length = further, 2 * length
    return rows


def ancestor_steps(comments: DataFrame, items: DataFrame, walk_rounds: int = WALK_ROUNDS) -> DataFrame:
    """``(id, depth, ancestor)``: the direct parent at depth 0, up to below the story.

    Every asked ``id`` counts once.  Posts that are nowhere in ``items`` end a chain; parents that form
    a cycle are an error.
    """
    asked = stage(comments.select("id").distinct(), "asked")
    first = keep_in(items, "id", asked)
    started = stage(
        first.where(_below_story()).select(
            "id", F.lit(0).alias("depth"), F.col("parent").alias("ancestor"), "top_level_parent"
        ),
        "walk",
    )
    start = started.select("id", "depth", "ancestor")
    few = walk_rounds > 0 and asked.count() * WALK_SHARE <= items.count()
    found, still = _walked(start, items, walk_rounds) if few else ([], start)
    if not (few and still.isEmpty()):
        # the threads of what is still on its way; their roots are staged, so that few of them are
        # broadcast and many are met in a plain shuffle
        mine = keep_in(started, "id", still.select("id").distinct()) if few else started
        roots = stage(mine.select("top_level_parent").distinct(), "roots")
        found = [*found, _climbed(still, keep_in(items, "top_level_parent", roots))]
    return reduce(DataFrame.unionByName, found or [start])


def ancestor_rows(comments: DataFrame, items: DataFrame, text: Column | None = None, reader=None) -> DataFrame:
    """``(id, depth, author, text)``, one row per ancestor, depth 0 nearest.

    Ids are resolved first; texts are fetched once at the end, those of
    ancestors only.  ``text`` (default: the column) is what is wanted of a text: it is worked
    out once per post, before posts are repeated for all comments below them.  Where texts are
    stored apart, ``reader`` reads them, a part at a time.
    """
    steps = stage(ancestor_steps(comments, items), "ancestors")
    wanted = (F.col("text") if text is None else text).alias("text")
    told = [F.col("id").alias("ancestor"), F.col("by").alias("author"), wanted]
    people = keep_in(items, "id", steps.select("ancestor").distinct())
    if reader is None:
        people = people.select(*told)
    else:
        people = stage(people.select("id", "by", "text_key"), "people")
        people = stage_steps([part.select(*told) for part in reader.only(people).steps(people)], "people")
    # unlike a plain join, this one leaves hot ancestors open to being split
    return attach(steps, people, ["ancestor"], "inner").select("id", "depth", "author", "text")


def ancestor_chain(comments: DataFrame, items: DataFrame, text: Column | None = None, reader=None) -> DataFrame:
    """Add ``chain``: array of (author, text), nearest ancestor first.

    The arrays are as long as the comment is deep, never as long as a thread.  ``text`` and ``reader``
    as in ``ancestor_rows``.
    """
    chains = (
        ancestor_rows(comments, items, text, reader)
        .groupBy("id")
        .agg(F.array_sort(F.collect_list(F.struct("depth", "author", "text"))).alias("found"))
        .select(
            "id",
            F.transform(
                "found", lambda a: F.struct(a["author"].alias("author"), a["text"].alias("text"))
            ).alias("chain"),
        )
    )
    none = F.array().cast("array<struct<author:string,text:string>>")
    return comments.join(chains, "id", "left").withColumn("chain", F.coalesce("chain", none))


# --- composite ---------------------------------------------------------------


def augment_comments(items: DataFrame, read: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Comments with sibling count, sibling rank, level and readable text.

    The three numbers are worked out on ids; text is moved once, to meet them,
    and not at all when the items are stored in buckets of ``id``.  Where texts are stored
    apart, ``read`` adds them to the finished rows; it finds all columns of ``items``.
    """
    comments = items.where(F.col("type") == "comment")
    edges = comments.select("id", "parent", "top_level_parent")
    numbers = (
        sibling_rank(siblings_count(edges), items)
        .join(reply_levels(edges), "id", "left")
        .drop("parent", "top_level_parent")
    )
    kept = ["id", "by", "time", "text", "parent", "top_level_parent", "kids"]
    rows = (comments.select(*kept) if read is None else comments).join(numbers, "id")
    whole = rows if read is None else read(rows)
    return whole.select(*kept, *numbers.columns[1:]).withColumn("text", unescape_html(F.col("text")))
