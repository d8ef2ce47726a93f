"""Reply-forest operators against plain Python on random forests."""

import random

import pytest
from pyspark.sql import functions as F

from agora import schemas
from agora.operators import forest

EDGE = "id long, parent long, top_level_parent long"


def random_forest(seed: int, threads: int = 6, size: int = 60, deep: float = 0.5):
    """Edges of threads whose comments prefer recent parents, so that some run deep."""
    rng, edges, next_id = random.Random(seed), [], 1
    for _ in range(threads):
        root, members = next_id, [next_id]
        next_id += 1
        for _ in range(rng.randint(1, size)):
            parent = members[-1] if rng.random() < deep else rng.choice(members)
            edges.append((next_id, parent, root))
            members.append(next_id)
            next_id += 1
    rng.shuffle(edges)
    return edges


def levels_by_hand(edges, max_level=24):
    parent = {i: (p, r) for i, p, r in edges}
    out = {}
    for start in parent:
        node, level, seen = start, 0, set()
        while True:
            up, root = parent[node]
            if up == root:
                out[start] = level if level <= max_level else -1
                break
            if up not in parent or up in seen:
                out[start] = -1
                break
            seen.add(up)
            node, level = up, level + 1
    return out


def collected(df, value):
    return {row["id"]: row[value] for row in df.collect()}


@pytest.mark.parametrize("seed,deep", [(1, 0.3), (2, 0.8), (3, 0.97)])
def test_levels_match_walk(frame, seed, deep):
    edges = random_forest(seed, deep=deep)
    found = forest.nested_level(frame(edges, EDGE))
    assert collected(found, "nested_level") == levels_by_hand(edges)


def test_levels_stop_at_24(frame):
    chain = [(i, i - 1, 0) for i in range(1, 31)]
    found = collected(forest.nested_level(frame(chain, EDGE)), "nested_level")
    assert [found[i] for i in range(1, 31)] == [*range(25), -1, -1, -1, -1, -1]


@pytest.mark.parametrize("cap", [0, 1, 2, 3, 6, 7, 8])
def test_levels_respect_any_cap(frame, cap):
    chain = [(i, i - 1, 0) for i in range(1, 13)]
    found = collected(forest.reply_levels(frame(chain, EDGE), cap), "nested_level")
    assert found == {i: (i - 1 if i - 1 <= cap else -1) for i in range(1, 13)}


def test_levels_with_gaps_cycles_and_nulls(frame):
    edges = [
        (1, 100, 100), (2, 1, 100),          # regular
        (3, 999, 100), (4, 3, 100),          # parent is not in the table
        (5, 6, 100), (6, 5, 100),            # cycle
        (7, None, 100), (8, 7, 100),         # no parent
        (9, 1, None), (10, None, None),
    ]
    found = collected(forest.nested_level(frame(edges, EDGE)), "nested_level")
    assert found == {1: 0, 2: 1, 3: -1, 4: -1, 5: -1, 6: -1, 7: -1, 8: -1, 9: 1, 10: -1}


@pytest.mark.parametrize("seed,rounds", [(4, 6), (5, 2), (6, 0)])
def test_closure_holds_chains_of_well_ranked_comments(frame, seed, rounds):
    rng = random.Random(seed)
    rows = [(*e, rng.choice([-1, 1, 1, 2, 3, 4])) for e in random_forest(seed, deep=0.7)]
    found = forest.thread_closure(
        frame(rows, EDGE + ", sibling_rank int"), max_rank=3, rounds=rounds
    )
    ids = {row["id"] for row in found.collect()}
    of = {i: (p, r, k) for i, p, r, k in rows}

    def depth(i):
        """Replies between a comment and its story if all of them are well ranked."""
        steps = 0
        while i in of and of[i][2] <= 3 and steps <= len(of):
            if of[i][0] == of[i][1]:
                return steps
            i, steps = of[i][0], steps + 1
        return None

    assert ids == {i for i in of if depth(i) is not None and depth(i) <= rounds}


@pytest.mark.parametrize("seed", [7, 8])
def test_chains_match_walk(frame, seed):
    edges = random_forest(seed, deep=0.9)
    roots = {r for _, _, r in edges}
    posts = edges + [(r, None, r) for r in roots]
    items = frame(posts, EDGE).withColumns(
        {"by": F.concat(F.lit("u"), F.col("id")), "text": F.concat(F.lit("t"), F.col("id"))}
    )
    parent = {i: p for i, p, _ in edges}
    asked = [i for i, _, _ in edges if i % 3 == 0]
    wanted = frame([(i, r) for i, _, r in edges if i % 3 == 0], "id long, top_level_parent long")

    def walk(i, out=()):
        up = parent[i]
        return out if up in roots else walk(up, (*out, (f"u{up}", f"t{up}")))

    found = forest.ancestor_chain(wanted, items).collect()
    assert {r["id"]: tuple(map(tuple, r["chain"])) for r in found} == {i: walk(i) for i in asked}


@pytest.mark.parametrize("length", [1, 2, 3, 7])
def test_endless_chain_is_reported(frame, length):
    circle = [(i, i % length + 1, 0) for i in range(1, length + 1)]
    edges = frame([*circle, (100, 1, 0), (101, 100, 0)], EDGE)
    with pytest.raises(Exception, match="cycle"):
        forest.ancestor_steps(edges, edges).collect()


def test_a_list_with_many_repeats_is_settled_in_one_sort(frame):
    kids = [k for k in range(30_000) for _ in (0, 1)]
    items = frame([(1, kids), (2, [7, None, 7])], "id long, kids array<long>")
    ranks = collected(forest.kid_ranks(items).where("id is not null"), "sibling_rank")
    assert ranks == {k: 2 * k + 2 for k in range(30_000)} | {7: 3}


def test_kid_ranks(frame):
    items = frame([(1, [11, 12, 11]), (2, [12, 13]), (3, None), (4, [])], "id long, kids array<long>")
    # 11 is listed twice by 1, 12 by 1 and 2: the last mention holds.
    assert collected(forest.kid_ranks(items), "sibling_rank") == {11: 3, 12: 1, 13: 2}
    ids = frame([(11,), (13,), (99,)], "id long")
    assert collected(forest.sibling_rank(ids, items), "sibling_rank") == {11: 3, 13: 2, 99: -1}
    assert forest.rank_stats(items).first().asDict() == {"max_rank": 3, "ranked_ids": 3}


def test_siblings_count_includes_self_and_survives_a_hot_parent(spark):
    rows = spark.range(60_000).select(
        "id", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 1000 + 100).alias("parent")
    )
    found = forest.siblings_count(rows)
    assert found.count() == 60_000
    assert found.where("parent = 7").select("siblings_count").distinct().first()[0] == 20_000


def test_comments_without_parent_are_one_group(frame):
    found = forest.siblings_count(frame([(1, None), (2, None), (3, 9)], "id long, parent long"))
    assert {r["id"]: r["siblings_count"] for r in found.collect()} == {1: 2, 2: 2, 3: 1}


def test_augmented_columns(frame):
    rows = [
        (1, "story", "a", None, None, "S", None, 5, None, None, 1, None, None, [2, 3]),
        (2, "comment", "b", None, "x &amp; y<p>z", None, None, None, None, 1, 1, None, None, [4]),
        (3, "comment", "c", None, None, None, None, None, None, 1, 1, None, None, None),
        (4, "comment", "d", None, "deep", None, None, None, None, 2, 1, None, None, None),
    ]
    found = {r["id"]: r for r in forest.augment_comments(frame(rows, schemas.ITEMS)).collect()}
    assert found[2]["text"] == "x & y\n\nz" and found[3]["text"] is None
    assert [found[i]["siblings_count"] for i in (2, 3, 4)] == [2, 2, 1]
    assert [found[i]["sibling_rank"] for i in (2, 3, 4)] == [1, 2, 1]
    assert [found[i]["nested_level"] for i in (2, 3, 4)] == [0, 0, 1]
