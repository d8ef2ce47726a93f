import hashlib

import pytest
from pyspark.sql import functions as F

from agora.operators import sampling


def unit(key, seed=42):
    return int(hashlib.md5(f"{seed}:{key}".encode()).hexdigest()[:8], 16) / 2**32


def order(keys, seed=42):
    return sorted(keys, key=lambda k: (unit(k, seed), k))


def ids(df):
    return {r["id"] for r in df.select("id").collect()}


@pytest.fixture(scope="module")
def numbers(spark):
    return spark.range(5000).withColumn("root", F.col("id") % 70)


def test_groups_never_straddle_splits(numbers):
    split = sampling.split_by_group(numbers, "root")
    per_root = split.groupBy("root").agg(F.countDistinct("split").alias("n"))
    assert per_root.where("n <> 1").count() == 0


def test_split_shares(spark):
    counts = {
        r["split"]: r["count"]
        for r in sampling.split_rows(spark.range(20_000)).groupBy("split").count().collect()
    }
    assert counts["train"] / 20_000 == pytest.approx(0.8, abs=0.02)
    assert counts["test"] / 20_000 == pytest.approx(0.1, abs=0.02)
    assert set(counts) == {"train", "test", "val"}


def test_split_label_by_hand(numbers):
    def label(key):
        u = unit(key)
        return "train" if u < 0.8 else "test" if u < 0.9 else "val"

    rows = sampling.split_by_group(numbers, "root").select("root", "split").distinct().collect()
    assert {r["root"]: r["split"] for r in rows} == {k: label(k) for k in range(70)}


@pytest.mark.parametrize("n", [0, 1, 7, 1000, 4999, 5000, 9000])
def test_sample_is_the_prefix_of_the_shuffle(numbers, n):
    assert ids(sampling.sample_n(numbers, n)) == set(order(range(5000))[:n])


def test_seeds_differ(numbers):
    assert ids(sampling.sample_n(numbers, 50, seed=1)) == set(order(range(5000), 1)[:50])


def test_sample_per_split(numbers):
    tagged = numbers.withColumn(
        "split", F.when(F.col("id") % 3 == 0, "train").when(F.col("id") % 3 == 1, "test").otherwise("val")
    )
    got = ids(sampling.sample_per_split(tagged, {"train": 30, "test": 100_000, "val": 0}))
    want = set(order(range(0, 5000, 3))[:30]) | set(range(1, 5000, 3))
    assert got == want
    assert ids(sampling.head_of_split(tagged, "val", 12)) == set(order(range(2, 5000, 3))[:12])


def test_equal_units_go_by_id(spark, monkeypatch):
    monkeypatch.setattr(sampling, "hash_unit", lambda key, seed=42: F.lit(0.25))
    assert ids(sampling.sample_n(spark.range(100), 10)) == set(range(10))


def test_shuffle_key(numbers):
    rows = sampling.with_shuffle_key(numbers).orderBy("shuffle_key", "id").collect()
    assert [r["id"] for r in rows] == order(range(5000))


@pytest.mark.parametrize("n", [1, 40, 2500, 4990])
def test_samples_of_any_size_order_a_window_only(numbers, n):
    assert ids(sampling.sample_n(numbers, n)) == set(order(range(5000))[:n])


def test_missed_windows_are_widened(spark, monkeypatch):
    # All units close to 1: the first windows hold no row at all.
    monkeypatch.setattr(
        sampling, "hash_unit", lambda key, seed=42: 0.9 + key.cast("double") / 1_000_000
    )
    assert ids(sampling.sample_n(spark.range(5000), 300)) == set(range(300))


@pytest.mark.parametrize("n,rows", [(3, 3), (5, 5), (7, 5), (50, 5)])
def test_rows_without_id_are_never_sampled(frame, n, rows):
    df = frame([(i if i % 2 else None, i) for i in range(10)], "id long, v int")
    found = sampling.sample_n(df, n).collect()
    assert len(found) == rows and all(r["id"] is not None for r in found)


def test_a_null_key_has_no_split(frame):
    df = frame([(None,), ("a",)], "id string")
    labels = {r["id"]: r["split"] for r in sampling.split_rows(df).collect()}
    assert labels[None] is None and labels["a"] is not None
