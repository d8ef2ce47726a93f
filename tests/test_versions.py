"""Published versions, shuffled tables and the log of steps."""

import pytest
from pyspark.sql import functions as F

from agora.operators import generations, sampling
from agora.sources import tables, versions
from agora.sources.memo import drop_table, materialize


def ids(df):
    return sorted(r["id"] for r in df.collect())


def test_readers_see_the_old_or_the_new_table(spark, fresh_path):
    path = fresh_path()
    with pytest.raises(FileNotFoundError):
        versions.read_published(spark, path)
    versions.publish(spark.range(3), path)
    old = versions.read_published(spark, path)
    versions.publish(spark.range(5, 9), path)
    assert ids(versions.read_published(spark, path)) == [5, 6, 7, 8]
    assert ids(old) == [0, 1, 2]  # a reader that had started goes on
    assert versions.prune(spark, path) == 1 and ids(versions.read_published(spark, path)) == [5, 6, 7, 8]


def test_a_failed_write_leaves_the_old_table(spark, fresh_path):
    path = fresh_path()
    versions.publish(spark.range(3), path)
    broken = spark.range(4).select(F.when(F.col("id") == 3, F.raise_error(F.lit("broken")).cast("long")).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="broken"):
        versions.publish(broken, path)
    assert ids(versions.read_published(spark, path)) == [0, 1, 2]

    def stop(rows, folder):
        rows.write.parquet(folder)
        raise RuntimeError("lost before the switch")

    with pytest.raises(RuntimeError):
        versions.publish(spark.range(9), path, stop)
    assert ids(versions.read_published(spark, path)) == [0, 1, 2]


def test_materialized_tables_are_refreshed_in_one_step(spark, fresh_path):
    path, built = fresh_path(), []

    def build(n):
        built.append(n)
        return spark.range(n)

    assert materialize(spark, path, lambda: build(2)).count() == 2
    assert materialize(spark, path, lambda: build(3)).count() == 2 and built == [2]
    # the new table may be made of the old one
    more = materialize(spark, path, lambda: versions.read_published(spark, path).union(spark.range(5)), refresh=True)
    assert more.count() == 7
    drop_table(spark, path)
    assert materialize(spark, path, lambda: build(4)).count() == 4


def test_written_tables_and_splits_are_replaced_whole(spark, fresh_path):
    path, splits = fresh_path(), fresh_path()
    for n in (2, 3, 4):
        tables.write_table(spark.range(n), path)
        seen = tables.scan_table(spark, path)
        tables.write_splits(spark.range(n).withColumn("split", F.lit("val")), splits, {"val": "validation"})
        assert tables.scan_split(spark, splits, "validation").count() == n
    broken = spark.range(1).select(F.raise_error(F.lit("broken")).cast("long").alias("id"))
    with pytest.raises(Exception, match="broken"):
        tables.write_table(broken, path)
    assert ids(tables.scan_table(spark, path)) == ids(seen) == [0, 1, 2, 3]
    plain = fresh_path()
    spark.range(7).write.parquet(plain)  # a folder of someone else's
    assert tables.scan_table(spark, plain).count() == 7


@pytest.fixture
def numbered(spark):
    rows = spark.range(5000).select("id", F.when(F.col("id") % 5 == 0, "test").otherwise("train").alias("split"))
    return rows.unionByName(spark.createDataFrame([(None, "train"), (None, "test"), (7, "train")], "id long, split string"))


def test_a_prefix_of_the_stored_order_reads_a_prefix_of_the_files(spark, fresh_path, numbered):
    path = fresh_path()
    sampling.write_shuffled(numbered, path, split="split", parts=32)
    stored = sampling.read_shuffled(spark, path)
    assert stored.count() == 5003 and set(stored.columns) == {"id", "split", "shuffle_key"}
    head = sampling.head_of_shuffled(spark, path, 100, split="train")
    wanted = sampling.with_shuffle_key(numbered.where("split = 'train' and id is not null")).orderBy("shuffle_key", "id").limit(100)
    assert [r["id"] for r in head.collect()] == [r["id"] for r in wanted.collect()]
    plan = head._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "shuffle_part" in plan
    opened = spark.read.parquet(path).where("split = 'train' and shuffle_part <= 1").select(F.input_file_name()).distinct().count()
    assert opened == 2 and len(stored.inputFiles()) >= 60
    assert sampling.head_of_shuffled(spark, path, 10_000).count() == 5001  # rows without id have no place
    assert sampling.head_of_shuffled(spark, path, 0).count() == 0


def test_files_lie_in_shuffled_order(spark, fresh_path, numbered):
    path = fresh_path()
    sampling.write_shuffled(numbered, path, parts=8)
    for part in range(8):
        keys = [r[0] for r in spark.read.parquet(f"{path}/shuffle_part={part}").select("shuffle_key").collect()]
        assert keys == sorted(keys) and part / 8 <= keys[0] and keys[-1] < (part + 1) / 8


def test_a_repeated_step_replaces_itself_and_nothing_else(spark, fresh_path):
    path = fresh_path()
    assert generations.logged_steps(spark, path) == []
    for step in (1, 2, 3):
        generations.log_step(spark.range(step * 10), path, step)
    files = {f for f in generations.read_steps(spark, path).inputFiles() if "step=2" not in f}
    generations.log_step(spark.range(100, 104), path, 2)
    log = generations.read_steps(spark, path)
    assert {f for f in log.inputFiles() if "step=2" not in f} == files
    assert {r["step"]: r["n"] for r in log.groupBy("step").agg(F.count("*").alias("n")).collect()} == {1: 10, 2: 4, 3: 30}
    generations.log_step(spark.range(0), path, 3)
    assert generations.logged_steps(spark, path) == [1, 2]
    assert generations.read_steps(spark, path, upto=1).count() == 10
