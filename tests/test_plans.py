"""Properties of the end-to-end jobs on the smallest tables."""

import pytest
from pyspark.sql import functions as F

from agora import fixed_values
from agora.catalog import views
from agora.operators import forest
from agora.plans import evaluations, pair_dataset, story_datasets

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def items(spark):
    return views.items(spark, SF_DIR)


@pytest.fixture(scope="module")
def built(items):
    return pair_dataset.build_pair_dataset(items, sample_size=40, split_sizes={"train": 15, "test": 4})


def test_roots_stay_in_one_split(built):
    per_root = built.pairs.groupBy("top_level_parent").agg(F.countDistinct("split").alias("n"))
    assert built.pairs.count() > 0 and per_root.where("n > 1").count() == 0


def test_the_better_rank_is_chosen(built):
    assert built.pairs.where("chosen_rank >= rejected_rank").count() == 0


def test_samples_have_their_size_and_prompts(built):
    total = built.pairs.count()
    assert built.sample.count() == min(40, total)
    assert built.sample.where("chosen_prompt_v1 is null or rejected_prompt_v2 is null").count() == 0
    sizes = {r["split"]: r["count"] for r in built.splits.groupBy("split").count().collect()}
    assert set(sizes) <= {"train", "test"} and sizes["train"] <= 15


def test_held_out_comments_are_not_in_training(built):
    train = built.splits.where("split = 'train'")
    seen = {r[0] for r in train.select(F.explode(F.array("chosen", "rejected"))).collect()}
    held = built.held_out.collect()
    assert held and not seen & {r["id"] for r in held}
    assert all(r["sibling_rank"] == 1 and r["prompt"].startswith("<instructions>") for r in held)


def test_closure_is_part_of_its_input_and_connected(items):
    comments = items.where("type = 'comment'").select("id", "parent", "top_level_parent")
    ranked = forest.sibling_rank(comments, items)
    kept = forest.thread_closure(ranked).collect()
    ids = {r["id"] for r in kept}
    assert ids <= {r["id"] for r in comments.collect()}
    assert all(r["parent"] == r["top_level_parent"] or r["parent"] in ids for r in kept)


def test_levels_grow_by_one(items):
    comments = items.where("type = 'comment'").select("id", "parent", "top_level_parent")
    level = {r["id"]: (r["nested_level"], r["parent"]) for r in forest.nested_level(comments).collect()}
    for own, parent in level.values():
        assert own == (level[parent][0] + 1 if parent in level else 0)


def test_story_styles_share_rows(items):
    plain = story_datasets.build_story_dataset(items)
    by = story_datasets.build_story_dataset(items, "by")
    assert plain.columns == list(fixed_values.STORY_COLUMNS)
    assert {r["id"] for r in plain.select("id").collect()} == {r["id"] for r in by.select("id").collect()}


def test_title_rows_carry_the_story(spark):
    stories = views.view(spark, SF_DIR, "scraped_stories")
    rows = story_datasets.build_title_rows(stories, "train", max_items=5, max_len=100_000).collect()
    assert len(rows) == 5
    for row in rows:
        assert [m["role"] for m in row["prompt"]] == ["system", "user"]
        assert row["prompt"][1]["content"].endswith(row["row"]["scraped_body"])
        assert row["row"]["score"] >= 20 and row["row"]["split"] == "train"


def test_sampled_comments_are_rated(items):
    comments = items.where("type = 'comment'").select("id", "by", "time", "text", "top_level_parent")
    rated = evaluations.rate_comments(comments, items, sample_size=25)
    reports = evaluations.rating_reports(rated, 3)
    assert rated.count() == 25
    top = [r["reward"] for r in reports["top"].collect()]
    bottom = [r["reward"] for r in reports["bottom"].collect()]
    assert len(top) == len(bottom) == 3 and min(top) >= max(bottom)
