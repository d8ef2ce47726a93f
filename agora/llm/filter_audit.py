"""How five document filters interact, over all 120 orders they can run in.

Every document gets a mask of the filters it fails (bit i: ``FILTERS[i]``):

  A  fewer than 50 words, words being maximal runs of no ASCII white space
  B  distinct words under 65 % of all words, upper and lower case told apart
  C  letters A-Z over 5 % of the code points
  D  one of ``#$%&*|`` in the text
  E  the very text of a document with a smaller id, anywhere in the table

Nothing else about a document matters to what an order of filters does with it, so
documents are counted by part and mask: at most 32 rows a part, however large the
table or its hot parts are.

Orders are numbered by their Lehmer rank, which is their place in lexicographic
order.  All orders that begin alike are neighbours: a prefix of k filters covers
(5-k)! ranks from its own first one.  A mask is removed at step k by exactly the
orders that begin with k-1 filters it passes and one it fails.  So each mask's
removals at a step are a few intervals of ranks; its count is added where an interval
starts and taken away where it ends, and a prefix sum over the 120 ranks gives what
every order removes at every step.

Nulls: a null text is an empty one, a null source the part with the empty name, a
null id is never larger or smaller than another and has no labels.  Empty texts fail
A only (and E if a smaller id has one).  Very long texts are handled whole.  Repeated
rows count each; rows with the same id and text are no copies of each other.  A
document is good (toxic) if one of its label rows says so.  An empty table gives no
rows.  Further columns of the tables are not read.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from agora.operators.joins import attach
from agora.sources.staging import stage

FILTERS = "ABCDE"
ORDERS = factorial(len(FILTERS))
LEAST_WORDS = 50
DISTINCT_PERCENT = 65
CAPITALS_PERCENT = 5
SPACES = r"[\x20\x09-\x0D]+"
SYMBOLS = "[#$%&*|]"


def _text_mask(words: Column, text: Column) -> Column:
    """The bits of the filters that look at one text only."""
    n_words, n_distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.char_length(text) - F.char_length(F.regexp_replace(text, "[A-Z]", ""))
    failing = [
        n_words < LEAST_WORDS,
        100 * n_distinct < DISTINCT_PERCENT * n_words,
        100 * capitals.cast("long") > CAPITALS_PERCENT * F.char_length(text).cast("long"),
        text.rlike(SYMBOLS),
    ]
    bits = [F.when(fails, 1 << bit).otherwise(0) for bit, fails in enumerate(failing)]
    return sum(bits[1:], bits[0])


def failure_masks(docs: DataFrame, part: str = "source") -> DataFrame:
    """doc_id, part and mask of every row, and ``copies``, what its text is compared by."""
    text = F.coalesce(F.col("text"), F.lit(""))
    read = docs.select("doc_id", F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), text.alias("text"))
    cut = read.withColumn("words", F.filter(F.split("text", SPACES), lambda word: word != ""))
    rows = stage(
        cut.select(
            "doc_id", "part", _text_mask(F.col("words"), F.col("text")).alias("mask"), F.sha2("text", 256).alias("copies")
        ),
        "filter-masks",
    )
    groups = rows.groupBy("copies").agg(F.min("doc_id").alias("first"), F.count("*").alias("n"))
    repeated = groups.where("n > 1").select("copies", "first")
    is_copy = F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False))
    mask = F.col("mask") + F.when(is_copy, 1 << FILTERS.index("E")).otherwise(0)
    return attach(rows, repeated, ["copies"]).select("doc_id", "part", mask.alias("mask"), "copies")


def removal_intervals() -> list[tuple[int, int, int, int]]:
    """(mask, step, first rank, rank after the last) of all orders that remove a mask at a step."""
    out = []
    for step in range(1, len(FILTERS) + 1):
        for prefix in permutations(range(len(FILTERS)), step):
            first = sum(
                sum(other < place and other not in prefix[:i] for other in range(len(FILTERS)))
                * factorial(len(FILTERS) - 1 - i)
                for i, place in enumerate(prefix)
            )
            after = first + factorial(len(FILTERS) - step)
            for mask in range(1 << len(FILTERS)):
                if mask >> prefix[-1] & 1 and not any(mask >> place & 1 for place in prefix[:-1]):
                    out.append((mask, step, first, after))
    return out


_COUNTS = ("removed", "good_lost", "toxic_lost")


def audit(docs: DataFrame, labels: DataFrame, part: str = "source") -> DataFrame:
    """One row per part, order of the filters and step, with what the step keeps and removes."""
    spark = docs.sparkSession
    says = lambda column: F.coalesce(F.max((F.col(column) == 1).cast("long")), F.lit(0)).alias(column)
    known = labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(says("quality"), says("toxic"))
    judged = attach(failure_masks(docs, part), known, ["doc_id"])
    counts = stage(
        judged.groupBy("part", "mask").agg(
            F.count("*").alias("removed"),
            F.coalesce(F.sum("quality"), F.lit(0)).alias("good_lost"),
            F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic_lost"),
        ),
        "filter-counts",
    ).repartition("part")  # at most 32 rows a part; all that follows stays in this partitioning

    having = lambda condition: F.sum(F.when(condition, F.col("removed")).otherwise(0))
    totals = counts.groupBy("part").agg(
        F.sum("removed").alias("total"),
        F.array(*[having(F.col("mask").bitwiseAND(1 << i) != 0) for i in range(len(FILTERS))]).alias("fails"),
        F.array(*[having(F.col("mask") == 1 << i) for i in range(len(FILTERS))]).alias("alone"),
    )
    # a fixed table: 840 intervals
    intervals = F.broadcast(spark.createDataFrame(removal_intervals(), "mask int, step int, first int, after int"))
    end = lambda rank, sign: F.struct(F.col(rank).alias("rank"), *[(sign * F.col(c)).alias(c) for c in _COUNTS])
    changes = counts.join(intervals, "mask").select("part", "step", F.inline(F.array(end("first", 1), end("after", -1))))
    grid = totals.select(
        "part",
        F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))).alias("step"),
    ).select(
        "part",
        "step",
        F.explode(F.sequence(F.lit(0), F.lit(ORDERS - 1))).alias("rank"),
        *[F.lit(0).cast("long").alias(c) for c in _COUNTS],
    )
    events = changes.where(F.col("rank") < ORDERS).unionByName(grid).groupBy("part", "step", "rank")
    along = Window.partitionBy("part", "step").orderBy("rank")
    steps = events.agg(*[F.sum(c).alias(c) for c in _COUNTS]).select(
        "part", "step", "rank", *[F.sum(c).over(along).alias(c) for c in _COUNTS]
    )

    names = F.array(*[F.lit("".join(order)) for order in permutations(FILTERS)])
    named = steps.withColumn("filter_order", F.get(names, F.col("rank")))
    letter = F.instr(F.lit(FILTERS), F.substring("filter_order", F.col("step"), F.lit(1))) - 1
    placed = named.withColumn("filter", letter).join(totals, "part")
    gone = F.sum("removed").over(Window.partitionBy("part", "rank").orderBy("step"))
    return placed.select(
        "part",
        "filter_order",
        "step",
        (F.col("total") - gone).alias("kept"),
        "removed",
        (F.get("fails", F.col("filter")) - F.col("removed")).alias("redundant"),
        F.get("alone", F.col("filter")).alias("unique_fails"),
        "good_lost",
        "toxic_lost",
        F.sum("removed").over(Window.partitionBy("part", "filter")).alias("shapley"),
    )


SQL = r"""
with read as (
  select doc_id, coalesce(source, '') as part, coalesce("text", '') as t from documents
),
cut as (
  select *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') as words,
    min(doc_id) over (partition by t) as first_id
  from read
),
known as (
  select doc_id, max(case when quality = 1 then 1 else 0 end) as good, max(case when toxic = 1 then 1 else 0 end) as bad
  from labels group by doc_id
),
failing as (
  select part, coalesce(good, 0) as good, coalesce(bad, 0) as bad,
    case when len(words) < 50 then 'A' else '' end
    || case when 100 * len(list_distinct(words)) < 65 * len(words) then 'B' else '' end
    || case when 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t) then 'C' else '' end
    || case when regexp_matches(t, '[#$%&*|]') then 'D' else '' end
    || case when doc_id > first_id then 'E' else '' end as fails
  from cut left join known using (doc_id)
),
grouped as (
  select part, fails, count(*) as n, sum(good) as good, sum(bad) as bad from failing group by part, fails
),
letters as (select unnest(['A', 'B', 'C', 'D', 'E']) as x),
orders as (
  select a.x || b.x || c.x || d.x || e.x as filter_order
  from letters a, letters b, letters c, letters d, letters e
  where len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
),
met as (
  select part, filter_order, step, substr(filter_order, step, 1) as f, n, good, bad, fails,
    contains(fails, substr(filter_order, step, 1)) as now,
    len(list_filter(range(1, step), lambda i: contains(fails, substr(filter_order, i, 1)))) > 0 as earlier
  from grouped, orders, (select unnest(range(1, 6)) as step) as steps
),
summed as (
  select part, filter_order, cast(step as integer) as step, f,
    sum(case when not now and not earlier then n else 0 end) as kept,
    sum(case when now and not earlier then n else 0 end) as removed,
    sum(case when now and earlier then n else 0 end) as redundant,
    sum(case when fails = f then n else 0 end) as unique_fails,
    sum(case when now and not earlier then good else 0 end) as good_lost,
    sum(case when now and not earlier then bad else 0 end) as toxic_lost
  from met group by part, filter_order, step, f
)
select part, filter_order, step, cast(kept as bigint) as kept, cast(removed as bigint) as removed,
  cast(redundant as bigint) as redundant, cast(unique_fails as bigint) as unique_fails,
  cast(good_lost as bigint) as good_lost, cast(toxic_lost as bigint) as toxic_lost,
  cast(sum(removed) over (partition by part, f) as bigint) as shapley
from summed
"""
