"""Batches of equal cost and prompts that are scored once."""

import random
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from agora.operators import scoring

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def padded_scorer():
    """Each row's score is what it takes in its batch: the length of the longest text."""
    return lambda texts: [float(max(map(len, texts)))] * len(texts)


@pytest.fixture(scope="module")
def long_tail(spark):
    rng = random.Random(2)
    rows = [(i, "x" * min(30_000, int(20 * rng.paretovariate(0.9)))) for i in range(6000)]
    rows += [(i, "same text " * 9) for i in range(6000, 8000)] + [(8000, None), (8001, ""), (8002, "y" * 60_000)]
    return spark.createDataFrame(rows, "id long, text string").repartition(5).cache()


def test_tasks_have_equal_cost(long_tail):
    dealt = scoring.balanced(long_tail, ["text"], 8)
    assert dealt.count() == long_tail.count() and dealt.rdd.getNumPartitions() == 8
    costs = [r["c"] for r in dealt.groupBy(F.spark_partition_id()).agg(F.sum(F.coalesce(F.length("text"), F.lit(0)) + 1).alias("c")).collect()]
    assert len(costs) == 8
    # a text is not cut: tasks differ by the longest one and by how a class of lengths is dealt
    assert max(costs) <= 1.1 * sum(costs) / 8 + 60_000
    short = scoring.balanced(long_tail.where("length(text) < 2000"), ["text"], 8)
    costs = [r["c"] for r in short.groupBy(F.spark_partition_id()).agg(F.sum(F.length("text") + 1).alias("c")).collect()]
    assert len(costs) == 8 and max(costs) <= 1.1 * sum(costs) / 8


def test_little_is_padded(long_tail):
    found = scoring.batch_score(long_tail, "id", "text", padded_scorer, padded=20_000, tasks=8)
    rows = found.join(long_tail, "id").where("text is not null").select("score", F.length("text").alias("n")).collect()
    assert sum(r["score"] for r in rows) <= 1.15 * sum(r["n"] for r in rows)
    mixed = scoring.batch_score(long_tail, "id", "text", padded_scorer, longest_first=False)
    assert mixed.agg(F.sum("score")).first()[0] > 5 * sum(r["n"] for r in rows)


def test_batches_end_at_rows_or_padded_size():
    import pandas as pd

    texts = pd.DataFrame({"t": ["x" * 50, "x" * 40, None, "x" * 10, "", "x" * 9, "x" * 1000, "y"]})
    assert list(scoring._batches(texts, 3, 100)) == [(0, 2), (2, 5), (5, 6), (6, 7), (7, 8)]
    assert list(scoring._batches(texts, 1, 10**9)) == [(i, i + 1) for i in range(8)]
    assert list(scoring._batches(texts.iloc[:0], 3, 100)) == []


def test_scores_do_not_depend_on_how_rows_are_dealt(long_tail):
    plain = {r["id"]: r["score"] for r in scoring.batch_score(long_tail, "id", "text").collect()}
    dealt = {r["id"]: r["score"] for r in scoring.batch_score(long_tail, "id", "text", padded=500, tasks=3).collect()}
    assert plain == dealt and plain[8000] is None
    assert scoring.batch_score(long_tail.where("false"), "id", "text", tasks=3).count() == 0


def counting(log_path):
    def make():
        def score(texts):
            with open(log_path, "a") as log:
                log.writelines(t + "\n" for t in texts)
            return [float(len(t)) for t in texts]
        return score
    return make


def test_a_prompt_in_many_pairs_is_scored_once(spark, tmp_path):
    rows = [(1, i, "best", f"worse {i}") for i in range(2, 30)] + [(2, 3, "worse 2", "worse 3"), (2, 3, "edited", None)]
    pairs = spark.createDataFrame(rows, "chosen long, rejected long, chosen_prompt string, rejected_prompt string")
    seen = tmp_path / "seen"
    found = scoring.score_pairs(pairs, counting(str(seen)))
    assert found.columns == [*pairs.columns, "chosen_reward", "chosen_reward_error", "rejected_reward", "rejected_reward_error"]
    got = sorted((r["chosen"], r["rejected"], r["chosen_reward"], r["rejected_reward"]) for r in found.collect() if r["rejected_prompt"])
    assert got == sorted((c, r, float(len(p)), float(len(q))) for c, r, p, q in rows if q)
    odd = found.where("rejected_prompt is null").first()
    assert (odd["chosen_reward"], odd["rejected_reward"]) == (6.0, None)
    assert sorted(seen.read_text().splitlines()) == sorted(["best", "edited", *{f"worse {i}" for i in range(2, 30)}])
