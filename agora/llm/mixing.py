"""Mixing sources to target weights, block by block, with DataFrame functions only.

The words of a source's documents, one document after the other, are packed into
blocks of ``block_words`` words.  The mix is a row of output shards of
``shard_slots`` slots.  In each shard a source has the whole part of its share of
the slots; the slots left over are drawn from the multinomial distribution of the
fractions.  A source numbers its slots through all shards; slot i stands for block
``i mod n`` under a pseudorandom permutation of the source's n blocks, another one
for each pass over them, and slots and blocks are joined by that number.

The permutation is a swap-or-not shuffle: in each round a number may trade places
with ``key - number``, and a hash of the pair decides.  It needs no table.

Targets: sources in code point order, null last, weigh 3, 1, 2, 3, 1, 2, ...; they
share ``share`` of all words by weight.  A target stops at ``most`` times its
source's size; what is above goes to the others by weight until none is above.  A
source never gives a block more than ``most`` times, so no document gives more than
``most`` times its words.

Sizes are words, runs of characters other than ASCII white space.  A null or empty
text has size 0 and gives nothing.  A null source is a source.  Repeated rows are
packed one after the other.  Without words every target is 0; an empty table gives
an empty result.  Source columns beyond doc_id, text and source are ignored.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from agora.llm.common import running_start, shuffle_parts
from agora.sources.staging import stage

BLOCK_WORDS = 32
SHARD_SLOTS = 4096
WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
ROUNDS = 10
#: Documents (and shards) of a source that one task orders at a time.
PIECE_ROWS = 2_000


class Mix(NamedTuple):
    """``documents``: doc_id, source, size, row_key and where each starts in its source's words.
    ``sources``: size, target, blocks.  ``taken``: the blocks of the mix, one row per slot."""

    documents: DataFrame
    sources: DataFrame
    taken: DataFrame


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """Sources (source, size) with rank, weight and target; one row per source goes through one task.

    With sources in ascending order of cap per weight, the level each would have
    if all earlier ones were capped is highest at the last one that is capped or
    next to it; that level times the weight, or the cap, is the target.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    by_cap = Window.orderBy("ratio", "rank").rowsBetween(Window.unboundedPreceding, -1)
    ranked = sizes.withColumn("rank", F.row_number().over(by_name)).withColumn(
        "weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") - 1) % len(weights) + 1)
    )
    levelled = (
        ranked.withColumn("cap", F.col("size") * float(most))
        .withColumn("ratio", F.col("cap") / F.col("weight"))
        .withColumn("total", F.sum("size").over(everything) * share)
        .withColumn("all_weights", F.sum("weight").over(everything))
        .withColumn("capped", F.coalesce(F.sum("cap").over(by_cap), F.lit(0.0)))
        .withColumn("gone", F.coalesce(F.sum("weight").over(by_cap), F.lit(0.0)))
        .withColumn("level", (F.col("total") - F.col("capped")) / (F.col("all_weights") - F.col("gone")))
        .withColumn("top", F.max("level").over(everything))
    )
    target = F.least(F.col("weight") * F.col("top"), F.col("cap"))
    return levelled.select("source", "size", "rank", "weight", target.alias("target"))


def permuted(number: Column, domain: Column, key: list[Column], rounds: int = ROUNDS) -> Column:
    """The place of ``number`` under a pseudorandom permutation of 0..domain-1 chosen by ``key``."""

    def trade(x: Column, r: Column) -> Column:
        other = F.pmod(F.pmod(F.xxhash64(*key, r), domain) - x, domain)
        coin = F.xxhash64(F.greatest(x, other), *key, r).bitwiseAND(F.lit(1))
        return F.when(coin == 1, other).otherwise(x)

    # a loop in one expression: as a chain of columns the plan would repeat each round in the next
    return F.aggregate(F.array(*[F.lit(r) for r in range(rounds)]), number.cast("long"), trade)


def _draws(sources: DataFrame, shard_slots: int, seed: int) -> DataFrame:
    """Slots per source and shard: rank, shard, slots.

    All shards are alike but the last, shorter one; the fractions of both kinds
    are two rows that hold one number per source.
    """
    spark = sources.sparkSession
    total = sources.agg(F.sum("slots")).first()[0] or 0.0
    every = int(round(total))
    shards = math.ceil(every / shard_slots)
    if not shards:
        return spark.createDataFrame([], "rank int, shard long, slots long")
    last = every - (shards - 1) * shard_slots
    kinds = F.explode(
        F.array(
            *[F.struct(F.lit(k).alias("kind"), F.lit(n).cast("long").alias("room")) for k, n in ((0, shard_slots), (1, last))]
        )
    )
    shares = (
        sources.select("rank", (F.col("slots") / total).alias("p"), kinds.alias("k"))
        .select("rank", "k.kind", "k.room", (F.col("p") * F.col("k.room")).alias("want"))
        .withColumn("whole", F.floor("want"))
        .withColumn("part", F.col("want") - F.col("whole"))
    )
    steps = stage(
        shares.withColumn("upto", F.sum("part").over(Window.partitionBy("kind").orderBy("rank"))), "mix-shares"
    )
    lists = steps.groupBy("kind").agg(
        F.max("room").alias("room"),
        (F.max("room") - F.sum("whole")).alias("left"),
        F.array_sort(F.collect_list(F.struct("rank", "upto", "part"))).alias("steps"),
    )
    all_shards = spark.range(shards).select(
        F.col("id").alias("shard"), F.when(F.col("id") == shards - 1, 1).otherwise(0).alias("kind")
    )
    unit = (F.pmod(F.xxhash64(F.lit(seed), F.col("shard"), F.col("draw")), F.lit(1 << 53)) / float(1 << 53)).alias("u")
    drawn = (
        all_shards.join(lists, "kind")
        .where(F.col("left") > 0)
        .select("shard", "steps", "left", F.explode(F.sequence(F.lit(1).cast("long"), F.col("left"))).alias("draw"))
        .select("shard", "steps", unit)
        .select("shard", "steps", (F.col("u") * F.element_at("steps", -1)["upto"]).alias("at"))
        .select(
            "shard",
            F.coalesce(
                F.element_at(F.filter("steps", lambda x: (x["upto"] > F.col("at")) & (x["part"] > 0)), 1)["rank"],
                F.element_at("steps", -1)["rank"],
            ).alias("rank"),
        )
        .groupBy("rank", "shard")
        .agg(F.count("*").alias("slots"))
    )
    whole = all_shards.join(steps, "kind").where(F.col("whole") > 0).select("rank", "shard", F.col("whole").alias("slots"))
    return whole.unionByName(drawn.select("rank", "shard", "slots")).groupBy("rank", "shard").agg(F.sum("slots").alias("slots"))


def row_key(docs: DataFrame) -> Column:
    """A hash of all columns; it tells nulls from one another by the columns they stand in."""
    named = sorted(docs.columns)
    nulls = F.concat(*[F.when(F.col(f"`{c}`").isNull(), "1").otherwise("0") for c in named])
    maps = {f.name for f in docs.schema.fields if "map<" in f.dataType.simpleString()}
    values = [F.to_json(F.struct(f"`{c}`")) if c in maps else F.col(f"`{c}`") for c in named]
    return F.xxhash64(nulls, *values)


def mix(
    docs: DataFrame,
    block_words: int = BLOCK_WORDS,
    shard_slots: int = SHARD_SLOTS,
    weights: tuple = WEIGHTS,
    share: float = SHARE,
    most: int = MOST,
    seed: int = 0,
) -> Mix:
    """Draw the mix of ``docs`` (doc_id, text, source); the same rows give the same mix."""
    sized = stage(
        docs.select(
            "doc_id", "source", word_count(F.col("text")).alias("size"), row_key(docs).alias("row_key")
        ),
        "mix-sizes",
    )
    sizes = sized.groupBy("source").agg(F.sum("size").alias("size"))
    blocks = F.ceil(F.col("size") / block_words).cast("long")
    ratio = F.when(F.col("size") > 0, F.col("target") / F.col("size")).otherwise(0.0)
    sources = stage(
        targets(sizes, weights, share, most).withColumn("blocks", blocks).withColumn("slots", F.col("blocks") * ratio),
        "mix-sources",
    )
    pieces = max(1, math.ceil(sized.count() / PIECE_ROWS))
    ranked = sized.alias("d").join(
        sources.select(F.col("source").alias("s"), "rank", "target", F.col("size").alias("source_size")),
        F.col("source").eqNullSafe(F.col("s")),
    )
    dealt = ranked.drop("s").withColumn("piece", F.pmod(F.xxhash64("row_key"), F.lit(pieces)).cast("long"))
    placed = running_start(dealt, ["rank"], "piece", ["row_key", "doc_id"], "size", "start")
    documents = stage(placed.drop("piece"), "mix-documents")
    draws = _draws(sources, shard_slots, seed).withColumn("piece", (F.col("shard") / 4096).cast("long"))
    numbered = running_start(draws, ["rank"], "piece", ["shard"], "slots", "first")
    taken = (
        numbered.where(F.col("slots") > 0)
        .repartition(shuffle_parts(docs.sparkSession), "rank", "shard")  # few rows that become many
        .select("rank", "shard", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("slots") - 1)).alias("slot"))
        .join(sources.select("rank", "blocks"), "rank")
        .where(F.col("slot") < F.col("blocks") * most)
        .withColumn("pass", F.floor(F.col("slot") / F.col("blocks")))
    )
    place = permuted(F.col("slot") % F.col("blocks"), F.col("blocks"), [F.lit(seed), F.col("rank"), F.col("pass")])
    taken = taken.withColumn("block", place)
    return Mix(documents, sources, taken.select("rank", "block", "pass", "shard", "slot"))


def document_pieces(mixed: Mix, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Parts of documents by block: rank, start (of the document), block, and words from..to of the document."""
    first, last = F.col("start"), F.col("start") + F.col("size")
    each = F.sequence(F.floor(first / block_words), F.floor((last - 1) / block_words))
    low, high = F.col("block") * block_words, (F.col("block") + 1) * block_words
    return (
        mixed.documents.where(F.col("size") > 0)
        .select("rank", "start", "size", F.explode(each).alias("block"))
        .select(
            "rank", "start", "block",
            (F.greatest(first, low) - first).alias("from"),
            (F.least(last, high) - first).alias("to"),
        )
    )


def taken_words(mixed: Mix, block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per document: doc_id, size, source_size, target of its source, words taken by the mix."""
    times = mixed.taken.groupBy("rank", "block").agg(F.count("*").alias("times"))
    words = (
        document_pieces(mixed, block_words)
        .join(times, ["rank", "block"])
        .groupBy("rank", "start")
        .agg(F.sum(F.col("times") * (F.col("to") - F.col("from"))).alias("taken"))
    )
    # documents without words share their start with the next one
    joined = mixed.documents.alias("d").join(
        words.alias("w"),
        (F.col("d.rank") == F.col("w.rank")) & (F.col("d.start") == F.col("w.start")) & (F.col("d.size") > 0),
        "left",
    )
    return joined.select(
        "d.doc_id", "d.size", "d.source_size", "d.target", F.coalesce("w.taken", F.lit(0)).cast("long").alias("taken")
    )


def mixed_documents(docs: DataFrame, mixed: Mix, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The mix as documents: for each document and pass over its source, the words that were taken.

    Columns are those of ``docs``.  A text that was taken whole is unchanged; of
    others the taken words are joined by single spaces, in the document's order.
    """
    # plain equality, so that the join builds on the shuffle that drops copies; the hash tells null from 0
    own_key = lambda key: (F.coalesce("doc_id", F.lit(0)).alias("id"), key.alias("key"))
    runs = (
        document_pieces(mixed, block_words)
        .join(mixed.taken.select("rank", "block", "pass"), ["rank", "block"])
        .groupBy("rank", "start", "pass")
        .agg(F.array_sort(F.collect_list(F.struct("from", "to"))).alias("runs"), F.sum(F.col("to") - F.col("from")).alias("got"))
    )
    chosen = mixed.documents.where(F.col("size") > 0).join(runs, ["rank", "start"]).select(
        *own_key(F.col("row_key")), "size", "runs", "got"
    )
    whole = F.col("row")["text"]
    words = F.regexp_extract_all(whole, F.lit("([^\\x20\\x09-\\x0D]+)"), F.lit(1))
    # the words are an argument of the inner function, or they would be cut out again for each run
    pick = lambda w: F.flatten(
        F.transform("runs", lambda r: F.slice(w, (r["from"] + 1).cast("int"), (r["to"] - r["from"]).cast("int")))
    )
    cut = F.array_join(F.element_at(F.transform(F.array(words), pick), 1), " ")
    # rows that share a key are the same in all columns: one of them stands for all
    rows = docs.select(*own_key(row_key(docs)), F.struct(*docs.columns).alias("row"))
    joined = rows.dropDuplicates(["id", "key"]).join(chosen, ["id", "key"])
    text = F.when(F.col("got") == F.col("size"), whole).otherwise(cut)
    out = joined.select("row", text.alias("taken"))
    made = {"text": F.col("taken")}
    if "n_chars" in docs.columns:
        made["n_chars"] = F.length("taken").cast(dict(docs.dtypes)["n_chars"])
    return out.select(*[made.get(c, F.col("row")[c]).alias(c) for c in docs.columns])
