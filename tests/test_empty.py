"""Tables without rows go through."""

import pytest
from pyspark.sql import functions as F

from agora import schemas
from agora.operators import benchmark, distributions, forest, metrics, ranking, sampling
from agora.operators.scoring import batch_score, length_scorer
from agora.plans import evaluations, pair_dataset, story_datasets
from agora.sources.result_store import ResultStore, score_incremental


@pytest.fixture
def items(spark):
    return spark.createDataFrame([], schemas.ITEMS)


def test_pair_dataset(items):
    built = pair_dataset.build_pair_dataset(items)
    for df in (built.pairs, built.sample, built.splits, built.held_out):
        assert df.count() == 0


def test_forest(items):
    assert forest.augment_comments(items).count() == 0
    assert forest.rank_stats(items).first().asDict() == {"max_rank": None, "ranked_ids": 0}


def test_stories_and_ratings(items):
    assert story_datasets.build_story_dataset(items).count() == 0
    assert evaluations.rate_comments(items, items, sample_size=5).count() == 0


def test_numbers(spark):
    df = spark.createDataFrame([], "id long, score long, x double, y double, split string, model string")
    assert distributions.histogram(df, "x").count() == 0
    assert distributions.histogram_by(df, "split", "x").count() == 0
    assert distributions.distribution_summary(df, "x").first().asDict() == dict.fromkeys(
        ["mean", "p5", "median", "p95", "std_dev"]
    )
    assert metrics.metrics_by_split(df, "x", "y").count() == 0
    assert sampling.sample_n(df, 3).count() == 0
    scored = df.withColumn("predictions", F.col("x"))
    assert ranking.score_leaderboards(evaluations.with_predicted_score(scored), 3).count() == 0


def test_scores(spark, fresh_path):
    df = spark.createDataFrame([], "id long, text string")
    assert batch_score(df, "id", "text").count() == 0
    store = ResultStore(spark, fresh_path())
    assert score_incremental(df, "f", ["text"], length_scorer, store, "text").count() == 0


def test_benchmark(spark):
    df = spark.createDataFrame([], schemas.MODEL_RESULT).select(
        F.lit(1).cast("long").alias("item_id"), F.lit("m").alias("model"),
        F.lit("t").alias("original_title"), F.lit(1.0).alias("rm_score_original"), "*",
    )
    assert benchmark.benchmark_summary(df).count() == 0
    assert benchmark.mean_score_by_model(benchmark.nest_results(df)).count() == 0
