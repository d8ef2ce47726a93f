"""One key with a third of all rows, joined by shuffling, split by adaptive execution."""

import contextlib

import pytest
from pyspark.sql import functions as F

from agora.operators import distributions, forest, joins
from agora.operators.pairs import preference_pairs
from agora.operators.prompting import comment_prompt
from agora.operators.scoring import length_scorer
from agora.sources.result_store import ResultStore, lookup_results, score_incremental

#: Settings that make this small data look like much: no broadcast, tiny skew limits.
LARGE = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "5KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "5KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.1",
    "spark.sql.shuffle.partitions": "16",
    # A hot partition is split by the tasks that wrote it, so there have to be several.
    "spark.sql.files.maxPartitionBytes": "50KB",
    "spark.sql.files.openCostInBytes": "0",
    "parquet.block.size": "20000",
}


@contextlib.contextmanager
def settings(spark, values):
    before = {key: spark.conf.get(key, None) for key in values}
    try:
        for key, value in values.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.fixture
def large(spark):
    with settings(spark, LARGE):
        yield spark


def final_plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def hot_comments(spark, rows=60_000):
    """A third of all comments answers post 1; the others spread over 2,000 posts."""
    hot = F.col("n") % 3 == 0
    return spark.range(rows).select(F.col("id").alias("n")).select(
        (F.col("n") + 1_000_000).alias("id"),
        F.when(hot, 1).otherwise(F.col("n") % 2000 + 10).alias("parent"),
        F.when(hot, 1).otherwise(F.col("n") % 2000 + 10).alias("top_level_parent"),
        (F.col("n") % 977 + 1).cast("int").alias("sibling_rank"),
        F.timestamp_seconds(F.col("n") % 3600).cast("timestamp_ntz").alias("time"),
    )


def test_sibling_counts_split_the_hot_parent(large):
    comments = hot_comments(large).withColumn("pad", F.sha2(F.col("id").cast("string"), 512))
    found = forest.siblings_count(comments)
    assert "skew=true" in final_plan(found)
    sizes = {r["siblings_count"] for r in found.select("siblings_count").distinct().collect()}
    assert 20_000 in sizes and found.count() == 60_000


def test_story_lookup_splits_the_hot_story(large):
    comments = hot_comments(large).withColumn("pad", F.sha2(F.col("id").cast("string"), 512))
    stories = large.range(2100).select(
        "id", F.lit("story").alias("type"), F.lit("t").alias("title"), F.lit("u").alias("url")
    )
    found = joins.with_story_info(comments, stories)
    assert "skew=true" in final_plan(found)
    assert found.where("story_title is not null").count() == 60_000


def test_pairs_of_a_hot_parent(large):
    comments = hot_comments(large, 6000)
    pairs = preference_pairs(comments)
    rows = {r["id"]: r for r in comments.collect()}
    found = pairs.collect()
    best = {}
    for row in rows.values():
        key = (row["sibling_rank"], row["id"])
        best[row["parent"]] = min(best.get(row["parent"], key), key)
    assert found and len({(r["chosen"], r["rejected"]) for r in found}) == len(found)
    for r in found:
        chosen, rejected = rows[r["chosen"]], rows[r["rejected"]]
        assert best[rejected["parent"]] == (chosen["sibling_rank"], chosen["id"])
        assert (rejected["time"] - chosen["time"]).total_seconds() <= 1800
        assert (r["chosen_rank"], r["rejected_rank"]) == (chosen["sibling_rank"], rejected["sibling_rank"])


def test_pair_joins_split_the_hot_parent(large):
    pairs = preference_pairs(hot_comments(large, 90_000), window_seconds=3000)
    assert final_plan(pairs).count("skew=true") >= 2


def test_group_histograms_split_the_hot_group(large):
    comments = hot_comments(large).withColumn("x", F.col("id").cast("double"))
    found = distributions.histogram_by(comments, "parent", "x")
    assert "skew=true" in final_plan(found)
    assert found.agg(F.sum("count")).first()[0] == 60_000


def test_result_lookups_split_a_text_with_many_copies(large, fresh_path):
    texts = large.range(60_000).select(
        "id",
        F.when(F.col("id") % 3 == 0, "same").otherwise(F.sha2(F.col("id").cast("string"), 256)).alias("t"),
        F.sha2(F.hex("id"), 512).alias("pad"),
    )
    store = ResultStore(large, fresh_path())
    scored = score_incremental(texts, "f", ["t"], length_scorer, store, "t")
    assert "skew=true" in final_plan(scored)
    assert scored.where("score is null").count() == 0 and scored.count() == 60_000
    found = lookup_results(texts, "f", ["t"], store)
    assert "skew=true" in final_plan(found)
    assert found.where("hit").count() == 60_000


def test_prompts_below_one_hot_story(large):
    posts = hot_comments(large, 90_000).select("id", "parent", "top_level_parent").unionByName(
        large.range(2100).select("id", F.lit(None).cast("bigint").alias("parent"), F.col("id").alias("top_level_parent"))
    )
    items = posts.withColumns({
        "by": F.lit("ann"), "title": F.when(F.col("parent").isNull(), "T"), "url": F.lit(None).cast("string"),
        "text": F.when(F.col("parent").isNotNull(), F.concat(F.lit("t"), F.col("id"))),
    })
    comments = items.where("parent is not null").select("id")
    prompts = comment_prompt(comments, items, ("v2",))
    assert "skew=true" in final_plan(prompts)
    assert prompts.count() == 90_000
    wanted = F.concat(
        F.lit("<story><title>T</title></story><parent_chain></parent_chain><comment><author>ann</author><text>t"),
        F.col("id"), F.lit("</text></comment>"),
    )
    assert prompts.where(F.col("prompt_v2") != wanted).count() == 0
