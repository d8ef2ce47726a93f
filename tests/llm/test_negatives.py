"""Hard negatives against all pairs."""

import math
import random

import numpy as np
import pytest

from agora.llm import multi_index

SCHEMA = "vec_id long, embedding array<double>, label int, score double"


def usable(rows):
    out = []
    for key, vector, label in rows:
        if None in (key, vector, label) or any(x is None or not math.isfinite(x) for x in vector):
            continue
        out.append((key, [math.floor(256 * x) if math.isfinite(256 * x) else 256 * int(x) for x in vector], label))
    return out


def by_all_pairs(rows, is_anchor, k=5, m=5):
    data = usable(rows)
    asked = {}
    for key, vector, label in data:
        if is_anchor(key):
            asked[key] = min(asked.get(key, (label, vector)), (label, vector))
    out = []
    for anchor, (label, vector) in asked.items():
        scored = sorted(
            (-sum(a * b for a, b in zip(vector, other)), key, own) for key, other, own in data if key != anchor
        )
        for score, positive, _ in [x for x in scored if x[2] == label][:k]:
            window = [x for x in scored if x[2] != label and 80 * -score <= 100 * -x[0] <= 100 * -score][:m]
            out += [(anchor, positive, n + 1, x[1], -score, -x[0]) for n, x in enumerate(window)]
    return sorted(out)


def run(spark, rows, is_anchor, **settings):
    frame = spark.createDataFrame([(*x, 0.5) for x in rows], SCHEMA)
    anchors = spark.createDataFrame([(*x, 0.5) for x in rows if x[0] is not None and is_anchor(x[0])], SCHEMA)
    return sorted(tuple(r) for r in multi_index.hard_negatives(frame, anchors, **settings).collect())


def clouds(n, width, seed=0, spread=0.15):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, width)) / math.sqrt(width)
    own = rng.integers(0, 6, n)
    points = centres[own] + spread * rng.normal(size=(n, width)) / math.sqrt(width)
    labels = np.where(rng.random(n) < 0.3, rng.integers(0, 6, n), own)
    return [(k, points[k].tolist(), int(labels[k])) for k in range(n)]


@pytest.mark.parametrize("n,width,shard_rows,words", [(700, 16, 100, 8), (700, 7, 5000, 16), (60, 1, 20, 4)])
def test_all_pairs_agree(spark, n, width, shard_rows, words):
    rows = clouds(n, width)
    asked = lambda key: key % 10 == 0
    found = run(spark, rows, asked, shard_rows=shard_rows, words=words)
    assert found == by_all_pairs(rows, asked) and found


def test_odd_rows(spark):
    rows = clouds(80, 4, seed=3)
    rows += [(100, None, 1), (110, [1.0, None, 0.0, 0.0], 1), (120, [math.nan, 0.0, 0.0, 0.0], 1), (130, [math.inf] * 4, 2)]
    rows += [(140, [0.1, 0.2], 1), (150, [], 1), (160, [0.0] * 4, 2), (None, [0.1] * 4, 1), (170, [0.1] * 4, None)]
    rows += [(11, rows[11][1], rows[11][2])] * 2 + [(20, rows[20][1], rows[20][2])]  # repeated, one of them an anchor
    rows += [(200 + k, rows[30][1], rows[30][2]) for k in range(9)]  # ties
    rows += [(300, [3e5, 1.0, -2.0, 0.5], 1), (301, [2.9e5, 1.0, 0.0, 0.5], 1), (302, [2.5e5, -1.0, 0.0, 0.0], 2)]  # wide
    asked = lambda key: key % 10 == 0
    assert run(spark, rows, asked, shard_rows=30, words=4) == by_all_pairs(rows, asked)


def test_only_wide_rows_and_scores_beyond_a_long(spark):
    rows = [(10, [1e300, 0.0], 1), (11, [1e300, 1.0], 1), (12, [9e299, 0.0], 2), (13, [1.0, 0.0], 2), (14, [-1e308, 0.0], 1)]
    found = run(spark, rows, lambda key: key == 10)
    top = (1 << 63) - 1
    assert found[0] == (10, 11, 1, 12, top, top)


def test_empty_tables(spark):
    assert run(spark, [], lambda key: True) == []
    assert run(spark, clouds(20, 4), lambda key: False) == []


def test_cells_come_by_falling_bounds_that_hold():
    rows = clouds(400, 8, seed=5)
    vectors = [np.floor(256 * np.array(v)).astype("<i4").tobytes() for _, v, _ in rows]
    points = multi_index._matrix(vectors, 8)
    books = [multi_index._codebook(points[:, :4], 8), multi_index._codebook(points[:, 4:], 8)]
    shard = multi_index.Shard(books, 8, [k for k, _, _ in rows], [x for _, _, x in rows], [False] * 400, vectors)
    query, seen, last = points[17], 0, math.inf
    for bound, first, behind in shard.cells(query):
        assert bound <= last + 1e-9
        assert (shard.points[first:behind] @ query <= bound + 1e-6).all()
        last, seen = bound, seen + behind - first
    assert seen == 400


def test_certified_walks_stop_early():
    rng = random.Random(2)
    rows = [(k, [8.0 * (k % 4 == j) + rng.random() / 50 for j in range(4)], k % 4) for k in range(4000)]
    vectors = [np.floor(256 * np.array(v)).astype("<i4").tobytes() for _, v, _ in rows]
    points = multi_index._matrix(vectors, 4)
    books = [multi_index._codebook(points[:, :2], 8), multi_index._codebook(points[:, 2:], 8)]
    shard = multi_index.Shard(books, 4, [x[0] for x in rows], [x[2] for x in rows], [False] * 4000, vectors)
    seen = 0
    anchor = {"id": 0, "label": 0, "wide": False, "vector": vectors[0]}
    best = np.sort(points[1:][np.array([x[2] for x in rows[1:]]) == 0] @ points[0])[-5]
    for scores, _, _ in shard.walk(anchor, lambda: best):
        seen += len(scores)
    assert seen < 2000
