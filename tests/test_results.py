"""The keyed result table."""

import math
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from agora.operators.scoring import length_scorer
from agora.sources import result_store
from agora.sources.result_store import (
    ResultStore, arg_hash, evict_results, get_result, lookup_results, put_result, score_incremental,
)

# Scorers below travel by value, workers cannot import test modules.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


@pytest.fixture
def store(spark, fresh_path):
    return ResultStore(spark, fresh_path())


def counting(log_path):
    """A scorer that notes every text it sees; tasks append to one file."""
    def make():
        def score(texts):
            with open(log_path, "a") as log:
                log.writelines(t + "\n" for t in texts)
            return [float(len(t)) for t in texts]
        return score
    return make


def failing():
    def score(texts):
        if any("bad" in t for t in texts):
            raise ValueError("cannot score")
        return [float(len(t)) for t in texts]
    return score


def texts(frame, *values):
    return frame([(i, v) for i, v in enumerate(values)], "id int, text string")


def scores(df):
    return {r["text"]: r["score"] for r in df.collect()}


def run(df, store, scorer=length_scorer, fn="f", **options):
    return score_incremental(df, fn, ["text"], scorer, store, "text", **options)


def hits(df, store, fn="f"):
    return {r["text"]: r["hit"] for r in lookup_results(df, fn, ["text"], store).collect()}


def test_second_call_is_a_hit(frame, store, tmp_path):
    seen = tmp_path / "seen"
    df = texts(frame, "ab", "abc")
    assert scores(run(df, store, counting(str(seen)))) == {"ab": 2.0, "abc": 3.0}
    assert hits(df, store) == {"ab": True, "abc": True}
    assert scores(run(df, store, counting(str(seen)))) == {"ab": 2.0, "abc": 3.0}
    assert sorted(seen.read_text().split()) == ["ab", "abc"]


def test_copies_are_scored_once(frame, store, tmp_path):
    seen = tmp_path / "seen"
    found = run(texts(frame, *["same"] * 50, "other"), store, counting(str(seen))).collect()
    assert len(found) == 51 and all(r["score"] is not None for r in found)
    assert sorted(seen.read_text().split()) == ["other", "same"]


def test_functions_have_their_own_keys(frame, store):
    df = texts(frame, "ab")
    run(df, store, fn="title length")
    assert hits(df, store, "title length") == {"ab": True}
    evict_results(store, "title length")
    assert hits(df, store, "title length") == {"ab": False}


def test_hash_covers_all_arguments(frame):
    df = frame([("a", "bc", None), ("ab", "c", None), ("a", "bc", 0)], "x string, y string, n int")
    keys = [r[0] for r in df.select(arg_hash(df, ["x", "y", "n"])).collect()]
    assert len(set(keys)) == 3


def test_evict_one_key(frame, store):
    df = texts(frame, "ab", "abc")
    run(df, store)
    gone = df.where("text = 'ab'").select(arg_hash(df, ["text"]).alias("arg_hash"))
    evict_results(store, "f", gone)
    assert hits(df, store) == {"ab": False, "abc": True}
    run(df, store)
    assert hits(df, store) == {"ab": True, "abc": True}


def test_evict_one_function(frame, store):
    df = texts(frame, "ab")
    run(df, store, fn="v1/score")
    run(df, store, fn="v2/score")
    evict_results(store, "v1/score")
    assert hits(df, store, "v1/score") == {"ab": False}
    assert hits(df, store, "v2/score") == {"ab": True}


def test_evict_everything(frame, store):
    df = texts(frame, "ab")
    run(df, store, fn="one")
    run(df, store, fn="two")
    put_result(store, "k", 1)
    evict_results(store)
    assert hits(df, store, "one") == hits(df, store, "two") == {"ab": False}
    with pytest.raises(KeyError):
        get_result(store, "k")


def test_compacted_log_shows_the_same_rows(frame, store, fresh_path):
    df = texts(frame, "ab", "abc", "abcd")
    run(df, store, fn="kept")
    run(df, store, fn="gone")
    evict_results(store, "gone")
    first = df.where("text = 'abc'").select(arg_hash(df, ["text"]).alias("arg_hash"))
    evict_results(store, "kept", first)
    small = store.compacted(fresh_path())
    for fn in ("kept", "gone"):
        assert hits(df, small, fn) == hits(df, store, fn)
    assert hits(df, small, "kept") == {"ab": True, "abc": False, "abcd": True}
    assert small._log().count() == 2
    run(df, small, fn="gone")
    assert hits(df, small, "gone") == {"ab": True, "abc": True, "abcd": True}


def test_only_wanted_rows_of_the_log(frame, store):
    run(texts(frame, *[f"t{i}" for i in range(40)]), store)
    asked = texts(frame, "t1", "t2", "new")
    wanted = asked.select(arg_hash(asked, ["text"]).alias("arg_hash"))
    assert store.live("f", wanted).count() == 2


def test_ten_keys_open_few_files(spark, frame, store):
    run(texts(frame, *[f"t{i}" for i in range(3000)]), store)
    whole = len(store._log().inputFiles())
    asked = texts(frame, *[f"t{i}" for i in range(10)])
    wanted = asked.select(arg_hash(asked, ["text"]).alias("arg_hash"))
    found = store.live("f", wanted)
    assert found.count() == 10
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "hash_part" in plan
    parts = {r["arg_hash"][:2] for r in wanted.collect()}
    scan = store._log().where(F.col("hash_part").isin(list(parts)))
    opened = scan.select(F.input_file_name()).distinct().count()
    assert whole == 256 and opened <= 10


def test_hot_text_and_other_partitions_stay_when_one_is_compacted(spark, frame, store):
    df = texts(frame, *[f"t{i}" for i in range(40)])
    for first in range(0, 40, 8):  # five appends
        run(df.where(f"id >= {first} and id < {first + 8}"), store)
    run(df, store, refresh=True)
    gone = df.where("id = 3").select(arg_hash(df, ["text"]).alias("arg_hash"))
    evict_results(store, "f", gone)
    before, files = hits(df, store), len(store._log().inputFiles())
    assert store.compact("f", max_files=100) == []
    assert store.compact("f", max_files=1)
    after = len(store._log().inputFiles())
    assert after < files and hits(df, store) == before and not before["t3"] and before["t4"]
    files = store._log().select("hash_part", F.input_file_name().alias("file")).distinct()
    assert files.groupBy("hash_part").count().where("count > 1").count() == 0
    evict_results(store, "f")
    store.compact("f", max_files=0)
    assert store._log().where("arg_hash is not null").count() == 0
    assert not any(hits(df, store).values())


def test_texts_are_hashed_once(spark, frame, store, monkeypatch):
    run(texts(frame, "old"), store)
    labels, plans, plain = [], [], result_store.stage

    def noted(df, label):
        labels.append(label)
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return plain(df, label)

    monkeypatch.setattr(result_store, "stage", noted)
    found = run(texts(frame, "old", "new", "new"), store)
    plans.append(found._jdf.queryExecution().optimizedPlan().toString())
    assert sum("sha2" in plan for plan in plans) == 1 and len(found.collect()) == 3


def test_direct_values(store):
    put_result(store, "key", "value")
    assert get_result(store, "key") == "value"
    with pytest.raises(KeyError):
        get_result(store, "nothing")
    put_result(store, "key", {"new": [1, None]})
    assert get_result(store, "key") == {"new": [1, None]}


def test_cache_only(frame, store):
    df = texts(frame, "ab", "abc")
    with pytest.raises(KeyError):
        run(df, store, cache_only=True)
    run(df, store)
    assert scores(run(df, store, cache_only=True)) == pytest.approx(
        {"ab": math.log(3), "abc": math.log(4)}
    )


def test_refresh_recomputes(frame, store, tmp_path):
    seen = tmp_path / "seen"
    df = texts(frame, "ab")
    run(df, store)
    assert scores(run(df, store, counting(str(seen)), refresh=True)) == {"ab": 2.0}
    assert seen.read_text() == "ab\n"


def test_failures_are_reported_and_not_kept(frame, store):
    df = texts(frame, "fine", "bad one", "also fine")
    found = {r["text"]: (r["score"], r["error"]) for r in run(df, store, failing).collect()}
    assert found["fine"] == (4.0, None) and found["also fine"] == (9.0, None)
    assert found["bad one"][0] is None and "cannot score" in found["bad one"][1]
    assert hits(df, store) == {"fine": True, "bad one": False, "also fine": True}
