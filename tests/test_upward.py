"""How much the walks and rankings of the reply forest move."""

import math

import pytest
from pyspark.sql import functions as F

from agora.operators import forest


@pytest.fixture
def staged(monkeypatch):
    """Rows of every table staged by the forest operators."""
    counts, plain = [], forest.stage

    def counted(df, label):
        made = plain(df, label)
        counts.append(made.count())
        return made

    monkeypatch.setattr(forest, "stage", counted)
    return counts


def chain(spark, n, root=0):
    """Comments 1..n, each answering the one before, under the story 0."""
    return spark.range(1, n + 1).select(
        "id", (F.col("id") - 1).alias("parent"), F.lit(root).cast("long").alias("top_level_parent")
    )


def bushy(spark, n):
    """Comment i answers comment i / 3; those below 3 answer the story 0."""
    return spark.range(1, n + 1).select(
        "id", F.floor(F.col("id") / 3).alias("parent"), F.lit(0).cast("long").alias("top_level_parent")
    )


def test_one_comment_of_a_large_thread_walks_its_own_ancestors(spark, staged):
    items = bushy(spark, 100_000)
    found = forest.ancestor_steps(items.where("id = 99999"), items).orderBy("depth").collect()
    wanted, post = [], 99_999 // 3
    while post:
        wanted.append(post)
        post //= 3
    assert [(r["depth"], r["ancestor"]) for r in found] == list(enumerate(wanted))
    assert sum(staged) <= 3 * len(wanted) + 3


def test_comments_that_share_ancestors_look_each_one_up_once(spark, staged):
    items = bushy(spark, 30_000)
    asked = items.where("id % 100 = 0")
    found = forest.ancestor_steps(asked, items)
    depth = {r["id"]: r["n"] for r in found.groupBy("id").agg(F.count("*").alias("n")).collect()}
    assert depth == {i: len([k for k in range(1, 12) if i // 3**k]) for i in range(100, 30_001, 100)}
    assert sum(staged) <= found.count() + 3 * asked.count()


def test_a_chain_of_fifty_thousand(spark, staged):
    n = 50_000
    items = chain(spark, n)
    found = forest.ancestor_steps(items.where(f"id = {n}"), items, walk_rounds=3)
    assert found.agg(F.count("*"), F.sum("ancestor"), F.max("depth")).first()[:] == (n - 1, n * (n - 1) // 2, n - 2)
    assert found.where(F.col("ancestor") + F.col("depth") != n - 1).count() == 0
    assert max(staged) <= n + 1


@pytest.mark.parametrize("walk_rounds", [0, 2, 10])
def test_walking_and_climbing_agree(spark, walk_rounds):
    items = bushy(spark, 3000).unionByName(chain(spark, 40, root=10_000).withColumns(
        {"id": F.col("id") + 10_000, "parent": F.col("parent") + 10_000}
    ))
    asked = items.where("id % 77 = 0 or id = 10040")
    found = forest.ancestor_steps(asked, items, walk_rounds=walk_rounds)
    parent = {r["id"]: r["parent"] for r in items.collect()}
    wanted = set()
    for row in asked.collect():
        post, depth = parent[row["id"]], 0
        while post not in (0, 10_000):
            wanted.add((row["id"], depth, post))
            post, depth = parent[post], depth + 1
    assert {tuple(r) for r in found.collect()} == wanted


def test_ranking_work_grows_with_rows_not_with_rounds(spark, staged):
    moved = {}
    for n in (2_000, 16_000):
        staged.clear()
        found = forest.reply_levels(chain(spark, n), max_level=None)
        assert found.where("nested_level <> id - 1").count() == 0 and found.count() == n
        moved[n] = sum(staged) / n
    # doubling alone would move every row once more for each doubling of the depth
    assert moved[16_000] <= moved[2_000] + 0.5 * math.log2(8)
    assert moved[16_000] <= 16


def test_finished_rows_of_shallow_threads_do_not_move_again(spark, staged):
    n = 30_000
    found = forest.reply_levels(bushy(spark, n))
    assert found.where("nested_level < 0").count() == 0
    nodes, replied, *rounds = staged
    assert nodes == n and replied <= n / 3  # a third of the posts have replies
    assert replied + sum(rounds) < n


def test_any_depth_with_gaps_and_cycles(frame):
    edges = [(i, i - 1, 0) for i in range(1, 61)]
    edges += [(100, 999, 0), (101, 100, 0), (200, 201, 0), (201, 202, 0), (202, 200, 0), (203, 200, 0), (300, None, 0), (301, 300, 0)]
    found = forest.reply_levels(frame(edges, "id long, parent long, top_level_parent long"), max_level=None)
    levels = {r["id"]: r["nested_level"] for r in found.collect()}
    assert levels == {i: i - 1 for i in range(1, 61)} | {i: -1 for i in (100, 101, 200, 201, 202, 203, 300, 301)}


def test_cycles_above_a_few_asked_comments_are_an_error(spark, frame):
    circle = frame([(i, i % 3 + 1, 0) for i in range(1, 4)] + [(4, 1, 0)], "id long, parent long, top_level_parent long")
    items = circle.unionByName(chain(spark, 100).withColumns({"id": F.col("id") + 1000, "parent": F.col("parent") + 1000}))
    with pytest.raises(ValueError, match="cycle"):
        forest.ancestor_steps(frame([(4,)], "id long"), items, walk_rounds=4)
