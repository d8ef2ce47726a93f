"""Targets, permutation, words taken and the pipeline."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from agora.llm import mixing


def shares(sizes):
    """Targets by sharing again and again what is above a cap."""
    names = sorted(sizes, key=lambda x: (x is None, x or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    target, left, free = {}, 1.5 * sum(sizes.values()), set(names)
    while free:
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if weight[s] * level > 2 * sizes[s]}
        if not over:
            return target | {s: weight[s] * level for s in free}
        for s in over:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
        free -= over
    return target


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_targets_are_shared_until_none_is_above(spark, seed):
    rng = random.Random(seed)
    sizes = {s: rng.choice([0, 3, 50, 4000, 90_000]) for s in ["b", "a", "é", "z", "Z", None, "aa", ""]}
    df = spark.createDataFrame(list(sizes.items()), "source string, size long")
    found = {r["source"]: r["target"] for r in mixing.targets(df).collect()}
    assert found == pytest.approx(shares(sizes))


def test_permutation_is_one(spark):
    for n in (1, 2, 7, 1000):
        df = spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n), [F.lit(5), F.lit("a")]).alias("x"))
        order = [r["x"] for r in df.collect()]
        assert sorted(order) == list(range(n)) and (n < 1000 or order != sorted(order))


@pytest.fixture(scope="module")
def table(spark):
    rng = random.Random(9)
    rows = []
    for i in range(400):
        source = "hot" if i % 3 == 0 else rng.choice(["a", "b", "c", None])
        rows.append((i, " ".join(f"w{i}_{k}" for k in range(rng.choice([1, 5, 60, 400])))
                     , "en", source, 0))
    rows += [(500, None, "en", "a", 0), (501, "", "en", "a", 0), (502, "x", "en", "only empty", 0), (7, rows[7][1], "en", rows[7][3], 0), (None, "no id here", "en", "b", 0)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").cache()


def test_taken_words_come_near_the_targets(table):
    mixed = mixing.mix(table, block_words=8, shard_slots=500)
    found = mixing.taken_words(mixed, block_words=8).cache()
    rows = found.collect()
    assert len(rows) == table.count()
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in rows)
    by_source = found.join(table.select("doc_id", "source").distinct(), "doc_id").groupBy("source").agg(
        F.sum("taken").alias("taken"), F.max("target").alias("target"), F.max("source_size").alias("size")
    )
    for row in by_source.where("size > 1000").collect():
        assert row["taken"] == pytest.approx(row["target"], rel=0.03)
    again = mixing.taken_words(mixing.mix(table.repartition(5), block_words=8, shard_slots=500), block_words=8)
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted(map(tuple, again.collect()), key=key) == sorted(map(tuple, rows), key=key)
    each = mixed.taken.groupBy("rank", "block").count()
    assert each.agg(F.max("count")).first()[0] <= 2
    documents = mixing.mixed_documents(table, mixed, block_words=8)
    assert documents.columns == table.columns
    got = documents.agg(F.sum(mixing.word_count(F.col("text")))).first()[0]
    assert got == sum(r["taken"] for r in rows)
    own = {r["doc_id"]: set((r["text"] or "").split()) for r in table.collect()}
    assert all(set(r["text"].split()) <= own[r["doc_id"]] and r["n_chars"] == len(r["text"]) for r in documents.collect())


def test_nothing_to_mix(table):
    for part in (table.where("false"), table.where("doc_id in (500, 501)")):
        mixed = mixing.mix(part)
        assert all(r["taken"] == 0 and r["target"] == 0 for r in mixing.taken_words(mixed).collect())
        assert mixing.mixed_documents(part, mixed).count() == 0


def test_the_pipeline_runs_its_stages_in_order(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    before = docs
    for name, function in corpus_pipeline.STAGES:
        after = function(spark, before, folder)
        if name != "token_files":
            assert sorted(after.columns) == sorted(docs.columns), name
        rows = after.count()
        if name in ("toxicity", "near_duplicates", "decontamination"):
            assert rows <= before.count() and after.join(before, "doc_id", "left_anti").count() == 0
        if name != "token_files":
            before = after.cache()
    assert rows == before.count()
    assert corpus_pipeline.run(spark, folder).count() == rows


def test_repeated_rows_keep_their_own_source(spark):
    text = " ".join(f"w{i}" for i in range(300))
    rows = [(1, text, "en", "x", 5), (1, text, "en", "y", 5), (1, text, "de", "y", 5), (1, text, None, None, 5), (2, "other words", "en", "x", 5)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    mixed = mixing.mix(table, block_words=8, shard_slots=50)
    found = mixing.mixed_documents(table, mixed, block_words=8)
    assert {(r["source"], r["lang"]) for r in found.where("doc_id = 1").collect()} == {("x", "en"), ("y", "en"), ("y", "de"), (None, None)}
    words = {(r["source"], r["target"]): r["n"] for r in mixing.taken_words(mixed, block_words=8).join(
        mixed.sources.select("source", "target"), "target").groupBy("source", "target").agg({"taken": "sum"}).toDF("source", "target", "n").collect()}
    mixed_words = {r["source"]: r["n"] for r in found.selectExpr("source", "size(split(text, ' ')) as n").groupBy("source").sum("n").toDF("source", "n").collect()}
    assert sum(words.values()) == sum(mixed_words.values())
