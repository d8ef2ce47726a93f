import pytest
from pyspark.sql import functions as F

from agora.catalog import views
from agora.functions.numbers import natural_log
from agora.operators import ranking
from agora.plans import evaluations, pair_dataset, publishing, story_datasets
from agora.sources import tables

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def items(spark):
    return views.items(spark, SF_DIR)


def test_pairs(spark, items, fresh_path):
    folder = fresh_path()
    built = pair_dataset.build_pair_dataset(items)
    publishing.publish_pairs(built, folder)
    for version in ("v1", "v2"):
        found = tables.scan_table(spark, f"{folder}/sample_pairs_{version}")
        assert set(found.columns) == {
            "chosen", "rejected", "chosen_rank", "rejected_rank", "top_level_parent", "split",
            "chosen_prompt", "rejected_prompt",
        }
        assert found.count() == built.splits.count()
    first = tables.scan_split(spark, f"{folder}/sample_pairs_v1", "train").first()
    assert first["chosen_prompt"].startswith("<instructions>")
    assert tables.scan_table(spark, f"{folder}/top_comments").count() == built.held_out.count()


def test_leaderboards(spark, items, fresh_path):
    folder = fresh_path()
    stories = story_datasets.build_story_dataset(items)
    scored = stories.withColumn("predictions", natural_log(F.col("id") % 50 + 1))
    publishing.publish_leaderboards(scored, folder, n=3)
    schema = "serialized string, predicted_score long, score long, score_diff long, link string"
    ranked = evaluations.with_predicted_score(scored)
    for name, (column, desc, only) in ranking.LEADERBOARDS.items():
        pool = ranked if only is None else ranked.where(F.col("score") == only)
        wanted = [r["serialized"] for r in ranking.top_n(pool, column, 3, desc).collect()]
        found = tables.scan_csv_report(spark, f"{folder}/{name}", schema)
        assert [r["serialized"] for r in found.collect()] == wanted


def test_ratings(spark, items, fresh_path):
    folder = fresh_path()
    comments = items.where("type = 'comment'").select("id", "by", "time", "text", "top_level_parent")
    publishing.publish_ratings(evaluations.rate_comments(comments, items, sample_size=20), folder, 5)
    schema = "date string, by string, link string, story_title string, text string, reward double"
    for name in ("top", "bottom"):
        found = tables.scan_csv_report(spark, f"{folder}/{name}_comments", schema).collect()
        rewards = [r["reward"] for r in found]
        assert len(rewards) == 5 and rewards == sorted(rewards, reverse=name == "top")


def test_benchmark(spark, fresh_path):
    folder = fresh_path()
    results = views.view(spark, SF_DIR, "title_results")
    publishing.publish_benchmark(results, folder, ["b", "a", "c"])
    by_item = tables.scan_results_json(spark, f"{folder}/by_item")
    assert by_item.count() == results.select("item_id").distinct().count()
    assert by_item.first()["model_results"].keys() == {"a", "b", "c"}
    assert tables.scan_table(spark, f"{folder}/by_model").count() == 3
