import datetime as dt
import hashlib
import sys
import types

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql import types as T

from agora import schemas
from agora.catalog import QUERIES
from agora.operators import benchmark, filters, generations, joins, ranking, training
from agora.operators.scoring import batch_score, score_columns, score_titles
from agora.plans import evaluations, story_datasets
from agora.sources import memo, staging, tables

# Scorers below travel by value, workers cannot import test modules.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


# --- files --------------------------------------------------------------------


def test_splits_round_trip(spark, frame, fresh_path):
    path = fresh_path()
    df = frame([(1, "train"), (2, "val"), (3, "test")], "id int, split string")
    tables.write_splits(df, path, {"val": "validation"})
    assert [r["id"] for r in tables.scan_split(spark, path, "validation").collect()] == [2]
    plan = tables.scan_split(spark, path, "test")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan


def test_csv_keeps_quotes_and_newlines(spark, frame, fresh_path):
    path = fresh_path()
    df = frame([("a \"b\"\n, c", 1), ("plain", 2), ("back\\slash", None), ("\n padded \n", 4), ("", 5), (None, 6)], "text string, n int")
    tables.write_csv_report(df, path)
    got = tables.scan_csv_report(spark, path, df.schema).collect()
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, df.collect()), key=str)


def test_items_round_trip(spark, frame, fresh_path):
    path = fresh_path()
    row = (1, "story", "a", dt.datetime(2020, 1, 1), "t", "T", None, 3, 0, None, 1, None, None, [2])
    tables.write_table(frame([row], schemas.ITEMS), path)
    items = tables.scan_items(spark, path)
    assert tuple(items.first()) == row
    tables.write_table(items.withColumn("id", F.lit("x")).drop("kids"), odd := fresh_path())
    with pytest.raises(TypeError, match="id: expected bigint, found string; kids: .* found nothing"):
        tables.scan_items(spark, odd)


def test_union_splits(frame):
    parts = {name: frame([(i,)], "id int") for i, name in enumerate(["train", "val"])}
    assert {tuple(r) for r in tables.union_splits(parts).collect()} == {(0, "train"), (1, "val")}


def test_materialize(spark, fresh_path):
    path, calls = fresh_path(), []

    def build():
        calls.append(1)
        return spark.range(len(calls))

    assert memo.materialize(spark, path, build).count() == 1
    assert memo.materialize(spark, path, build).count() == 1
    assert len(calls) == 1
    assert memo.materialize(spark, path, build, refresh=True).count() == 2
    memo.drop_table(spark, path)
    assert not memo.table_exists(spark, path)
    assert memo.materialize(spark, path, build).count() == 3


def test_resumed_predictions_join_inner(spark, frame, fresh_path):
    path = fresh_path()
    df = frame([(1, 0.5, "train"), (2, 0.7, "val")], "id long, log_score double, split string")
    only_first = lambda d: d.where("id = 1").select("id", F.lit(9.0).alias("predictions"))
    memo.resume_predictions(df, path, only_first)
    again = memo.resume_predictions(df, path, lambda d: pytest.fail("scored twice"))
    assert [tuple(r) for r in again.collect()] == [(1, 0.5, "train", 9.0)]


def test_staging_uses_the_sessions_folder(spark):
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    root = staging.scratch_root(spark)
    if configured:
        assert root == configured.rstrip("/")
    staged = staging.stage(spark.range(3), "test")
    assert staged.count() == 3 and root.split(":")[-1] in staged.inputFiles()[0]


def stub_session(master, configured=None):
    context = types.SimpleNamespace(
        master=master, applicationId=f"app-{master}", getCheckpointDir=lambda: None
    )
    settings = {"spark.checkpoint.dir": configured}
    conf = types.SimpleNamespace(get=lambda key, default=None: settings.get(key) or default)
    return types.SimpleNamespace(sparkContext=context, conf=conf)


def test_clusters_need_a_shared_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        staging.scratch_root(stub_session("spark://host:7077"))
    assert staging.scratch_root(stub_session("yarn", "hdfs://shared/")) == "hdfs://shared"
    local = stub_session("local[2]")
    assert staging.scratch_root(local) == staging.scratch_root(local)


def test_release_deletes_this_applications_tables(spark, fresh_path, monkeypatch):
    folder = fresh_path()
    monkeypatch.setattr(staging, "_folder", lambda _: folder)
    staged = staging.stage(spark.range(3), "test")
    assert staged.count() == 3
    staging.release(spark)
    with pytest.raises(Exception, match="(?i)not.?exist|not.?found"):
        spark.read.parquet(staged.inputFiles()[0]).count()


# --- filters and joins ----------------------------------------------------------


def test_story_filters(frame):
    base = dict(id=0, type="story", time=dt.datetime(2020, 1, 1), text="t", title="T", url=None,
                score=1, dead=None, deleted=None)
    variants = [{}, {"type": "job"}, {"time": None}, {"text": None}, {"url": "u"}, {"dead": True},
                {"deleted": False}]
    rows = [tuple({**base, **v, "id": i}.values()) for i, v in enumerate(variants)]
    df = frame(rows, "id int, type string, time timestamp_ntz, text string, title string, url string,"
                     " score int, dead boolean, deleted boolean")
    assert [r["id"] for r in filters.filter_text_stories(df).collect()] == [0]
    assert [r["id"] for r in filters.filter_stories_with_text(df).collect()] == [0, 4, 5, 6]


def test_time_filters(frame):
    times = [dt.datetime(2015, 12, 31, 23, 59), dt.datetime(2016, 1, 1), dt.datetime(2016, 1, 31, 23),
             dt.datetime(2016, 2, 1), None]
    df = frame([(i, t) for i, t in enumerate(times)], "id int, time timestamp_ntz")
    kept = lambda d: [r["id"] for r in d.collect()]
    assert kept(filters.filter_time_range(df, ge="2016-01-01 00:00:00")) == [1, 2, 3]
    assert kept(filters.filter_time_range(df, gt="2016-01-01 00:00:00")) == [2, 3]
    assert kept(filters.filter_time_range(df, lt="2016-01-01 00:00:00")) == [0]
    assert kept(filters.filter_calendar(df, 2016, 1)) == [1, 2]
    assert kept(filters.filter_calendar(df, 2015, 12)) == [0]
    assert kept(filters.filter_calendar(df, 2016)) == kept(filters.filter_calendar(df, 2016, op=">="))


def test_usable_text_counts_characters(frame):
    rows = [(1, "é" * 11, 1), (2, "é" * 10, 1), (3, None, 1), (4, "x" * 50, -1)]
    df = frame(rows, "id int, text string, sibling_rank int")
    assert [r["id"] for r in filters.filter_usable_text(df).collect()] == [1]


def test_title_filter_drops_null_titles(frame):
    df = frame([("Ask: Who is hiring?",), ("who is hiring",), (None,)], "title string")
    assert [r[0] for r in filters.exclude_title_containing(df).collect()] == ["who is hiring"]


def test_keep_and_exclude(frame):
    df, ids = frame([(1,), (2,), (None,)], "id int"), frame([(2,), (None,)], "other int")
    assert [r[0] for r in joins.keep_in(df, "id", ids).collect()] == [2]
    assert [r[0] for r in joins.exclude_in(df, "id", ids, ids).collect()] == [1]


# --- rankings and results ---------------------------------------------------------


def test_top_n_puts_nulls_first_and_breaks_ties_by_id(frame):
    df = frame([(4, 1), (3, 5), (2, 5), (1, None)], "id int, v int")
    assert [r["id"] for r in ranking.top_n(df, "v", 3).collect()] == [1, 2, 3]
    assert [r["id"] for r in ranking.bottom_n(df, "v", 2).collect()] == [1, 4]


def test_leaderboards(frame):
    rows = [(i, i % 7, (i * 5) % 11, f"s{i}") for i in range(40)]
    df = frame(rows, "id long, score long, predicted_score long, serialized string")
    got = ranking.score_leaderboards(df, n=5).collect()
    by_hand = {
        "top_predicted": sorted(rows, key=lambda r: (-r[2], r[0])),
        "top_actual": sorted(rows, key=lambda r: (-r[1], r[0])),
        "bottom_predicted": sorted(rows, key=lambda r: (r[2], r[0])),
        "top_underperform": sorted(rows, key=lambda r: (r[1] - r[2], r[0])),
        "top_overperform": sorted(rows, key=lambda r: (r[2] - r[1], r[0])),
        "top_predicted_score_1": sorted([r for r in rows if r[1] == 1], key=lambda r: (-r[2], r[0])),
    }
    for name, wanted in by_hand.items():
        assert {r["id"] for r in got if r["list"] == name} == {r[0] for r in wanted[:5]}


LONG = ("item_id long, model string, generated_title string, original_title string,"
        " original_score long, score double, rm_score_original double, api_time double,"
        " total_time double, scraped_body string")


def test_benchmark_summary_of_a_failed_model(frame):
    rows = [(1, "ok", "t", "o", 5, 2.0, None, 0.5, 1.0, "b"), (2, "ok", "t", "o", 5, 4.0, 3.0, None, 2.0, "b"),
            (1, "bad", None, "o", 5, None, None, None, 9.0, "b")]
    got = {r["model"]: r.asDict() for r in benchmark.benchmark_summary(frame(rows, LONG)).collect()}
    assert got["ok"] == dict(model="ok", avg_score=3.0, median_score=3.0, avg_total_time=1.5,
                             avg_api_time=0.5, avg_rm_original_score=3.0, sample_count=2,
                             valid_sample_count=2)
    assert got["bad"] == dict(model="bad", avg_score=0.0, median_score=0.0, avg_total_time=0.0,
                              avg_api_time=0.0, avg_rm_original_score=None, sample_count=1,
                              valid_sample_count=0)


def test_nested_results(frame):
    rows = [(1, "x", "tx", "from x", 5, 2.0, 0.1, 0.5, 1.0, "b"),
            (1, "a", "ta", "from a", 5, None, 0.2, 0.5, 1.0, "b")]
    df = frame(rows, LONG)
    first = benchmark.nest_results(df, ["x", "a"]).first()
    assert first["original_title"] == "from x" and set(first["model_results"]) == {"x", "a"}
    assert benchmark.nest_results(df).first()["original_title"] == "from a"
    titles = benchmark.rank_titles(benchmark.nest_results(df)).orderBy("place").collect()
    assert [(t["model"], t["score"]) for t in titles] == [("x", 2.0), ("Original", 0.2), ("a", None)]
    means = benchmark.mean_score_by_model(benchmark.nest_results(df)).collect()
    assert [tuple(m) for m in means] == [("x", 2.0), ("Original", 0.2)]


def by_length():
    def score(texts):
        if any("fail" in t for t in texts):
            raise RuntimeError("no score")
        return [float(len(t)) for t in texts]
    return score


def test_score_titles(frame):
    items = frame([(1, "Old", "me", "u", "body", 7), (2, "", "you", None, "b2", 8),
                   (3, "Lost", None, None, "b3", 9)],
                  "id long, title string, by string, url string, scraped_body string, score long")
    items = items.withColumn("time", F.lit("2020-01-02 00:00:00").cast("timestamp_ntz"))
    generated = frame(
        [(1, "m", ' "New" ', None, 1.0, 2.0), (1, "k", None, "boom", 1.0, 2.0),
         (1, "f", "fail", None, 1.0, 2.0), (2, "m", None, None, 1.0, 2.0),
         (3, "m", "T", None, 1.0, 2.0)],
        "item_id long, model string, content string, error string, api_time double, total_time double")
    got = {(r["item_id"], r["model"]): r for r in score_titles(items, generated, by_length).collect()}
    fine, broken, unscored = got[1, "m"], got[1, "k"], got[1, "f"]
    assert fine["generated_title"] == "New" and fine["score"] > 0 and fine["error"] is None
    assert broken["generated_title"] is None and broken["score"] is None
    assert broken["error"] == "boom" and broken["api_time"] is None
    assert broken["rm_score_original"] == fine["rm_score_original"] > 0
    assert unscored["generated_title"] == "fail" and unscored["api_time"] == 1.0
    assert unscored["score"] is None and unscored["error"] == "RuntimeError: no score"
    empty, anonymous = got[2, "m"], got[3, "m"]
    assert empty["generated_title"] == "" and empty["score"] > 0 and empty["rm_score_original"] is None
    assert anonymous["generated_title"] == "T" and anonymous["error"] == "by is missing"
    assert anonymous["score"] is None and anonymous["rm_score_original"] is None


def test_cross_models(frame):
    got = joins.cross_models(frame([(1,), (2,)], "id int"), ["a", "b"]).collect()
    assert {tuple(r) for r in got} == {(1, "a"), (1, "b"), (2, "a"), (2, "b")}


# --- scoring and training rows ------------------------------------------------------


def picky():
    def score(texts):
        if "bad" in texts:
            raise RuntimeError("no")
        return [float(len(t)) for t in texts]
    return score


def test_batch_score_keeps_errors_and_nulls(frame):
    df = frame([(1, "aa"), (2, "bad"), (3, None), (4, "cccc")], "id long, text string")
    got = {r["id"]: (r["score"], r["error"]) for r in batch_score(df, "id", "text", picky, 2).collect()}
    assert got[1] == (2.0, None) and got[3] == (None, None) and got[4] == (4.0, None)
    assert got[2] == (None, "RuntimeError: no")


def test_a_scorer_that_loses_rows_is_an_error(frame):
    def short():
        return lambda texts: [1.0] * (len(texts) - 1) if len(texts) > 1 else [2.0]

    df = frame([(i, "t") for i in range(5)], "id long, text string").coalesce(1)
    assert {r["score"] for r in batch_score(df, "id", "text", short).collect()} == {2.0}

    def silent():
        return lambda texts: []

    errors = {r["error"] for r in batch_score(df, "id", "text", silent).collect()}
    assert errors == {"ValueError: scorer returned 0 values for 1 texts"}


def in_order():
    """Scores a text by its place in the stream."""
    count = iter(range(10_000))
    return lambda texts: [float(next(count)) for _ in texts]


def test_longest_first(spark):
    df = spark.range(50, numPartitions=1).select("id", F.repeat(F.lit("x"), F.col("id").cast("int")).alias("t"))
    got = batch_score(df, "id", "t", in_order, 7).collect()
    assert {r["id"]: r["score"] for r in got} == {i: 49.0 - i for i in range(50)}


def test_score_columns_keeps_other_columns(frame):
    df = frame([("k", "ab", "abc")], "key string, a string, b string")
    row = score_columns(df, {"a": "sa", "b": "sb"}, picky).first()
    assert row["key"] == "k" and (row["sa"], row["sb"]) == (2.0, 3.0)


def test_training_rows_filter_after_taking(frame):
    rows = [(i, "train", 1, "w " * (i % 4 + 1)) for i in range(20)]
    df = frame(rows, "id long, split string, score long, serialized string")
    taken = training.training_rows(df, "train", 10)
    kept = training.training_rows(df, "train", 10, max_len=2)
    assert taken.count() == 10
    assert {r["id"] for r in kept.collect()} == {
        r["id"] for r in taken.collect() if len(r["tokens"]) <= 2
    }


def test_pair_rows_pad_and_cut(frame):
    df = frame([(1, 2, "a b c d", "e")], "chosen long, rejected long, chosen_prompt string, rejected_prompt string")
    row = training.pair_rows(df, max_len=3).first()
    assert row["input_ids_chosen"] == ["a", "b", "c"] and row["attention_mask_chosen"] == [1, 1, 1]
    assert row["input_ids_rejected"] == ["e", "", ""] and row["attention_mask_rejected"] == [1, 0, 0]


def test_python_tokenizers_plug_in(frame):
    tokenizer = training.arrow_tokenizer(lambda: lambda text: [len(word) for word in text.split()])
    df = frame([(1, 2, "aa b", "ccc"), (3, 4, None, "d")],
               "chosen long, rejected long, chosen_prompt string, rejected_prompt string")
    row = training.pair_rows(df, tokenizer, 3, F.lit(0).cast("bigint")).orderBy("chosen").first()
    assert row["input_ids_chosen"] == [2, 1, 0] and row["attention_mask_chosen"] == [1, 1, 0]
    assert row["input_ids_rejected"] == [3, 0, 0]
    assert df.select(tokenizer(F.col("chosen_prompt"))).collect()[1][0] is None


def test_chat_length(frame):
    chat = T.ArrayType(schemas.CHAT_MESSAGE)
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("prompt", chat)])
    df = frame([(1, [("user", "a b")]), (2, [("user", "a " * 50)])], schema)
    assert [r["id"] for r in training.filter_chat_length(df, 10).collect()] == [1]
    assert tuple(training.chat_length_report(df, 10).first()) == (2, 1)


def test_generation_table(frame):
    rows = [(s, i, f"in{i}", f"out{i}", float(i), {"m": 0.5}) for s in (10, 20) for i in range(4)]
    df = frame(rows, "step int, sample int, input string, output string, score double, metrics map<string,double>")
    got = generations.generation_table(df, 2).orderBy("step").collect()
    assert got[0].asDict() == dict(
        step=10, input_1="in0", output_1="out0", score_1=0.0, metrics_1="m=0.5",
        input_2="in1", output_2="out1", score_2=1.0, metrics_2="m=0.5",
    )
    both = generations.accumulate_steps([generations.generation_table(df.where(f"step = {s}"), 2) for s in (10, 20)])
    assert both.count() == 2


def test_ranked_titles_leave_bodies_unread(frame):
    rows = [(1, "x", "tx", "o", 5, 2.0, 0.1, 0.5, 1.0, "body")]
    nested = benchmark.nest_results(frame(rows, LONG))
    assert nested.first()["scraped_body"] == "body"
    plan = benchmark.rank_titles(nested)._jdf.queryExecution().optimizedPlan().toString()
    assert "max(scraped_body" not in plan


def test_failed_results_keep_their_response(frame):
    rows = [(1, "x", None, "o", 5, None, None, 0.5, 1.0, "b", "raw", "timeout")]
    nested = benchmark.nest_results(frame(rows, LONG + ", full_response string, error string")).first()
    result = nested["model_results"]["x"]
    assert (result["full_response"], result["error"]) == ("raw", "timeout")


def test_chats_are_gathered_only_as_far_as_they_fit(spark, frame, fresh_path):
    rows = [(1, t, "user", f"w{t} " * (t % 4)) for t in range(-300, 700)]  # one that holds most rows
    rows += [(2, 0, "user", "a"), (2, 1, "tool", None), (2, 1, None, "x"), (2, 1, "user", ""), (2, 1, "user", ""),
             (2, 9, "user", "b"), (3, 4, "user", "long " * 400), (3, 5, "user", "c"), (None, 1, "user", "x"), (4, None, "user", "y")]
    folder = fresh_path()
    frame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{folder}/conversations.parquet")
    wanted, known = [], [r for r in rows if r[0] is not None and r[1] is not None]
    for conv, turn, _, _ in known:
        said = sorted((r for r in known if r[0] == conv and r[1] < turn and None not in r), key=lambda r: r[1:])
        chat = "".join(f"<|im_start|>{r[2]}\n{r[3]}<|im_end|>\n" for r in said) + "<|im_start|>assistant\n"
        if len(chat.split()) <= 300:
            wanted.append((conv, turn, hashlib.md5(chat.encode()).hexdigest()))
    kept = QUERIES["chat_length_filter"](spark, folder)
    assert sorted(map(tuple, kept.collect())) == sorted(wanted)
    report = QUERIES["chat_length_report"](spark, folder)
    assert tuple(report.first()) == (len(known), len(wanted))
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan(report)
    gathering = plan(kept).split("collect_list", 1)[1]
    assert "< last#" in gathering  # cut before it is gathered


def test_title_requests_and_rewards(frame):
    stories = frame(
        [(1, "Old", "me", "u", "x" * 5000, 30, "val"), (2, "Low", "me", "u", "b", 3, "val"),
         (3, "Train", "me", "u", "b", 30, "train"), (4, None, None, None, None, 30, "val")],
        "id long, title string, by string, url string, scraped_body string, score long, split string")
    stories = stories.withColumn("time", F.lit("2020-01-02 00:00:00").cast("timestamp_ntz"))
    asked = {(r["item_id"], r["model"]): r for r in story_datasets.build_title_requests(stories, ["a", "b"]).collect()}
    assert set(asked) == {(1, "a"), (1, "b"), (4, "a"), (4, "b")}
    assert asked[1, "a"]["prompt"][1]["content"].count("x" * 4000) == 1
    assert "x" * 4001 not in asked[1, "a"]["prompt"][1]["content"]
    proposed = frame([(1, "New", "True"), (2, "fail", "true"), (3, "Bad", "False"), (4, "None", "True")],
                     "id long, title string, verdict string")
    got = {r["id"]: r for r in evaluations.reward_titles(stories, proposed, by_length).collect()}
    assert got[1]["reward"] == got[1]["metrics"]["rm"] > 5000 and got[1]["metrics"]["length"] == 3
    assert got[2]["reward"] is None and got[2]["error"] == "RuntimeError: no score"
    assert got[3]["reward"] == 0 and got[3]["metrics"]["rm"] > 0 and got[3]["metrics"]["matches"] == 0
    assert got[4]["reward"] is None and "is missing" in got[4]["error"]
