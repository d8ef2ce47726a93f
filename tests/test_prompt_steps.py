"""Prompts come in steps that move their own texts alone; what is made of them is that of all prompts at once."""

import glob
import random
from datetime import datetime, timedelta

import pytest

from agora.catalog import QUERIES, job_queries, views
from agora.operators import forest, prompting
from agora.operators.prompting import comment_prompt, dealt_by_thread, prompt_steps
from agora.plans import evaluations, pair_dataset
from agora.sources import staging
from pyspark.sql import functions as F

IDS = [0, 1, 2, 3, 3, 4, 5, None]


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tables"))
    rng = random.Random(3)
    docs = [(i, None if i == 4 else f"{i} \"&\" " + "".join(rng.choices("abc &<'", k=200))) for i in IDS]
    start = datetime(2020, 1, 1)
    rows = [(i, i % 50, "view" if i % 4 else "error", start + timedelta(seconds=i), float(i % 97)) for i in range(1500)]
    rows += [(70, 7, None, None, None), (None, 7, "view", start, 1.0)]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(
        rows, "event_id long, user_id long, event_type string, ts timestamp_ntz, value double"
    ).write.parquet(f"{folder}/events.parquet")
    return folder


@pytest.fixture
def small_steps(monkeypatch):
    monkeypatch.setattr(prompting, "STEP_POSTS", 1000)


@pytest.fixture
def smaller_steps(monkeypatch):
    monkeypatch.setattr(prompting, "STEP_POSTS", 20)


@pytest.fixture
def made(monkeypatch):
    """How many steps each staged table was made in."""
    counts, plain = {}, staging.stage_each

    def noted(spark, count, make, label):
        counts[label] = count
        return plain(spark, count, make, label)

    for module in (prompting, pair_dataset):
        monkeypatch.setattr(module, "stage_each", noted)
    return counts


def _sorted(df):
    return sorted(map(str, df.collect()))


def _pairs(spark, sf_dir):
    """All pairs with their prompts, from items that hold their texts."""
    return job_queries.prompted_pairs(spark, sf_dir)


@pytest.mark.parametrize("version", ["v1", "v2"])
def test_prompts_are_made_in_steps(spark, sf_dir, small_steps, made, version):
    found = QUERIES[f"comment_prompt_{version}"](spark, sf_dir)
    assert made["prompt-digests"] > 2
    whole = comment_prompt(views.comments(spark, sf_dir).select("id"), views.items(spark, sf_dir), (version,))
    text = f"prompt_{version}"
    assert _sorted(found) == _sorted(whole.select("id", F.md5(text).alias("md5"), F.length(text).cast("bigint").alias("chars")))
    # what the steps have staged is gone
    assert not glob.glob(f"{staging.scratch_root(spark)}/agora-*/step-*")


def test_steps_move_their_own_texts(spark, sf_dir, monkeypatch, small_steps):
    read, plain = [], views.TextReader.repeated

    def noted(self, rows):
        read.append(self.few.count())
        return plain(self, rows)

    monkeypatch.setattr(views.TextReader, "repeated", noted)
    rows = views.item_rows(spark, sf_dir)
    steps = prompt_steps(rows.where("type = 'comment' and id < 64"), rows, reader=views.text_reader(spark, sf_dir))
    assert steps.each(lambda prompts: prompts.select("id"), "ids").count() > 40
    assert len(read) == steps.count and max(read) <= len(IDS)


def test_large_threads_are_dealt_out(spark):
    rows = spark.range(4000).select("id", F.when(F.col("id") < 2000, 0).otherwise(F.col("id") - F.col("id") % 10).alias("top_level_parent"))
    dealt = dealt_by_thread(rows)
    shares = dealt.groupBy("top_level_parent").agg(F.count_distinct("share").alias("n"))
    assert shares.where("top_level_parent = 0").first()["n"] == prompting.STEPS
    assert shares.where("top_level_parent > 0 and n > 1").count() == 0 and dealt.count() == 4000


def test_comments_are_rated_in_steps(spark, sf_dir, small_steps, made):
    found = QUERIES["rated_comments"](spark, sf_dir)
    assert made["rewards"] > 2
    items = views.items(spark, sf_dir)
    asked = items.where("type = 'comment'").select("id", "by", "time", "text", "top_level_parent")
    whole = evaluations.rate_comments(asked, items, sample_size=None)
    reports = evaluations.rating_reports(job_queries._rated(whole))
    wanted = job_queries.tables_tagged(reports).select(*found.columns)
    assert _sorted(found) == _sorted(wanted) and found.count() == 200


def test_scored_pairs_come_in_steps(spark, sf_dir, smaller_steps, made):
    pairs = _pairs(spark, sf_dir)
    lengths = {s: F.round(F.log1p(F.length(f"{s}_prompt")), 6).alias(f"{s}_reward") for s in ("chosen", "rejected")}
    correct = (F.length("chosen_prompt") > F.length("rejected_prompt")).alias("correct")
    wanted = pairs.select("chosen", "rejected", *lengths.values(), correct)
    found = QUERIES["score_pairs"](spark, sf_dir)
    assert made["judged"] > 1 and _sorted(found) == _sorted(wanted) and found.count() > 4
    shares = QUERIES["pair_accuracy"](spark, sf_dir)
    assert shares.agg(F.sum("count")).first()[0] == found.count()


def test_pair_rows_come_in_steps(spark, sf_dir, smaller_steps, made):
    found = QUERIES["pair_rows"](spark, sf_dir)
    assert made["pair-rows"] > 1
    steps = [c for c in found.columns if c.startswith("chosen_") or c.startswith("rejected_")]
    several = {}
    for row in found.collect():
        several.setdefault(row["chosen"], set()).add(row["chosen_ids"])
    assert len(steps) == 4 and all(len(x) == 1 for x in several.values())


def test_ancestors_texts_are_read_in_parts(spark, sf_dir, monkeypatch):
    parts, plain = [], forest.stage_steps

    def noted(tables, label):
        parts.append((label, len(tables)))
        return plain(tables, label)

    monkeypatch.setattr(forest, "stage_steps", noted)
    found = QUERIES["ancestor_chain"](spark, sf_dir)
    assert parts == [("people", views.TextReader.STEPS)]
    asked = views.comments(spark, sf_dir).select("id", "top_level_parent")
    whole = forest.ancestor_chain(asked, views.items(spark, sf_dir), F.md5("text"))
    wanted = whole.select("id", F.posexplode("chain").alias("depth", "a")).select("id", "depth", "a.author", F.col("a.text").alias("md5"))
    assert _sorted(found) == _sorted(wanted) and found.count() > 100
