"""What queries over items put on scratch disk: rows stay in place and only texts that are read are moved."""

import random
from datetime import datetime, timedelta

import pytest

from agora.catalog import QUERIES, item_queries, views
from agora.operators import filters
from agora.sources import result_store
from pyspark.sql import functions as F

#: The fifth document has no text, number 3 is there twice, one has no number.
IDS = [0, 1, 2, 3, 3, 4, 5, None]


@pytest.fixture
def sf_dir(spark, tmp_path):
    rng = random.Random(7)
    docs = [(i, None if i == 4 else f"{i} " + "".join(rng.choices("abc &<", k=300))) for i in IDS]
    docs[4] = (3, "another three")
    start = datetime(2019, 1, 1)
    rows = [(i, i % 50, "view", start + timedelta(hours=i), float(i % 97)) for i in range(1500)]
    rows += [(64, 7, None, None, None), (0, 7, "view", start, 5.0), (None, 7, "view", start, 1.0)]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(
        rows, "event_id long, user_id long, event_type string, ts timestamp_ntz, value double"
    ).write.parquet(f"{tmp_path}/events.parquet")
    return str(tmp_path)


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def _sorted(df, *columns):
    return sorted(map(str, df.select(*columns).collect()))


def test_items_are_stored_without_a_shuffle(spark, sf_dir, monkeypatch):
    plans, stage = {}, views.stage

    def noted(df, label):
        plans[label] = df._jdf.queryExecution().executedPlan().toString()
        return stage(df, label)

    monkeypatch.setattr(views, "stage", noted)
    assert QUERIES["log_scores"](spark, sf_dir).count() > 0
    assert "Exchange hashpartitioning" not in plans["items"] and "Join" in plans["items"]


def test_whether_there_is_a_text_is_known_without_it(spark, sf_dir):
    assert "_body" not in _plan(QUERIES["mean_score_by_quarter"](spark, sf_dir))
    marks, items = views.item_marks(spark, sf_dir), views.items(spark, sf_dir)
    for kept in (filters.filter_stories_with_text, filters.filter_text_stories):
        found = _sorted(kept(marks), "id", "score", "time")
        assert found == _sorted(kept(items), "id", "score", "time") and found


def test_posts_move_their_own_texts_alone(spark, sf_dir):
    posts = item_queries.text_posts(spark, sf_dir)
    assert "LeftSemi" in _plan(posts)
    names = ["id", "by", "time", "text", "title", "score", "descendants"]
    found = _sorted(posts, *names)
    assert found == _sorted(filters.filter_text_stories(views.items(spark, sf_dir)), *names) and found


def test_hashes_are_found_in_steps(spark, sf_dir, monkeypatch):
    read, rows = views.text_reader(spark, sf_dir), views.item_rows(spark, sf_dir).select("id", "type", "text_key")
    counts, steps = [], result_store.stage_steps

    def noted(parts, label):
        counts.extend(part.count() for part in parts)
        return steps(parts, label)

    monkeypatch.setattr(result_store, "stage_steps", noted)
    keyed = result_store.key_rows(rows, ["text"], read)
    whole = read(rows)
    exact = whole.withColumn("arg_hash", result_store.arg_hash(whole, ["text"]))
    names = ["id", "type", "text_key", "arg_hash"]
    assert keyed.columns == names and _sorted(keyed, *names) == _sorted(exact, *names)
    assert len(counts) == views.TextReader.STEPS and sum(counts) == rows.count()
    some = rows.where("id < 100")
    assert _sorted(read.only(some)(some), "id", "text") == _sorted(read(some), "id", "text")
    assert some.where(F.col("text_key").isNull()).count() > 0
