"""FM-index, LSH forest, components and M-tree against brute force."""

import random
import re

import numpy as np
import pytest

from agora.llm import fm_index, lsh_forest, mtree
from agora.llm.components import components

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.mark.parametrize("n,kinds", [(1, 1), (50, 3), (400, 2), (3000, 50)])
def test_index_finds_every_occurrence(n, kinds):
    rng = np.random.default_rng(n)
    text = np.unique(np.append(rng.integers(1, kinds + 1, n), 0), return_inverse=True)[1]
    index = fm_index.Index(text)
    assert sorted(index.locate(np.arange(len(text))).tolist()) == list(range(len(text)))
    phrases = np.array([text[i : i + 3] for i in range(0, max(n - 3, 1), 7) if i + 3 <= len(text)])
    if len(phrases):
        low, high = index.search(phrases, np.full(len(phrases), 3))
        for phrase, a, b in zip(phrases, low, high):
            found = sorted(index.locate(np.arange(a, b)).tolist())
            assert found == [i for i in range(len(text) - 2) if (text[i : i + 3] == phrase).all()]


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def judged(text, items):
    own, hit, found = words(text), set(), set()
    for item, phrase in items:
        target = words(phrase)
        width = min(13, len(target))
        windows = {tuple(target[i : i + width]) for i in range(len(target) - width + 1)} if width else set()
        for i in range(len(own) - width + 1 if width else 0):
            if tuple(own[i : i + width]) in windows:
                hit.update(range(i, i + width))
                found.add(item)
    return len(own), len(hit), sorted(found)


@pytest.mark.parametrize("block_words", [10, 1_000_000])
def test_contamination_by_the_rule(docs, spark, block_words):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(40)] + ["É", "ñandú", "X"]
    item = lambda n: " ".join(rng.choices(vocabulary, k=n))
    items = [(k, item(n)) for k, n in enumerate([20, 13, 14, 5, 1, 30])] + [(6, ""), (7, None), (10, item(16))]
    items.append((11, items[0][1]))
    rows = [(i, " ".join([item(30), rng.choice(items)[1] or "", item(5)])) for i in range(60)]
    rows += [(90, None), (91, ""), (92, "...!"), (93, items[0][1].upper()), (94, item(200) + "\n" + items[10 - 2][1] + ", " + item(20_000)), (None, items[1][1]), (93, items[0][1].upper())]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = fm_index.find_contamination(docs(rows), benchmark, block_words=block_words, keep=("text", "score")).collect()
    assert len(found) == len(rows)
    known = [(i, t) for i, t in items if t]
    for row in found:
        n_words, n_hit, own = judged(row["kept_text"], known)
        assert (row["n_words"], row["n_hit"], row["items"]) == (n_words, n_hit, own)
        assert row["contaminated"] == (n_hit > 0 and 20 * n_hit >= n_words) and row["kept_score"] == -1.0
        inside = [w for s in row["spans"] for w in words(row["kept_text"][s["start"] : s["end"]])]
        assert len(inside) == n_hit


def test_removal_spans_are_cut_out(spark):
    df = spark.createDataFrame([("añb cd ef", [(0, 3), (4, 6)]), ("x", [])], "t string, s array<struct<start:int,end:int>>")
    assert [r[0] for r in df.select(fm_index.without_spans(df["t"], df["s"])).collect()] == ["  ef", "x"]


def test_no_benchmark_hits_nothing(docs, spark):
    none = spark.createDataFrame([], "item_id long, text string")
    row = fm_index.find_contamination(docs([(1, "a b")]), none).first()
    assert (row["n_words"], row["n_hit"], row["items"], row["contaminated"]) == (2, 0, [], False)
    assert fm_index.find_contamination(docs([]), none).count() == 0


def shingles(text):
    own = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if len(own) < 5:
        return frozenset([tuple(own)]) if own else frozenset()
    return frozenset(tuple(own[i : i + 5]) for i in range(len(own) - 4))


def least_reachable(rows):
    sets = {i: shingles(t) for i, t in rows}
    label = {i: i for i in sets}

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                x, y = root(a), root(b)
                label[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i)) for i in ids}


@pytest.mark.parametrize("bound", [1_000_000, 600])
def test_groups_are_those_of_all_links(docs, bound):
    rng = random.Random(11)
    word = lambda: "".join(rng.choices("abcdefgh", k=4))
    base = [word() for _ in range(60)]
    passage = [word() for _ in range(30)]
    rows = [(i, " ".join(word() for _ in range(rng.randint(1, 40)))) for i in range(40)]
    for i in range(100, 190):  # near copies, some beyond the threshold from each other
        copy = list(base)
        for _ in range(rng.randint(0, 4)):
            copy[rng.randrange(60)] = word()
        rows.append((i, " ".join(copy)))
    rows += [(i, " ".join([*passage, *(word() for _ in range(20))])) for i in range(200, 230)]
    rows += [(i, "Same  TEXT here") for i in range(300, 320)] + [(400, None), (401, ""), (402, " \n"), (403, "one"), (404, "ONE")]
    found = lsh_forest.near_duplicates(docs([*rows, (None, "one"), (403, "one")]), region_shingles=bound).collect()
    assert len(found) == len(rows) + 2
    wanted = least_reachable(rows)
    for row in found:
        if row["doc_id"] is None:
            assert row["kept"] and row["component_id"] is None
        else:
            assert (row["n_shingles"], row["component_id"]) == wanted[row["doc_id"]]
            assert row["kept"] == (row["doc_id"] == row["component_id"])


def test_region_cut_to_any_depth_keeps_its_links(docs):
    rng = random.Random(3)
    word = lambda: "".join(rng.choices("abcdefgh", k=5))
    rows, now = [], [word() for _ in range(124)]
    for i in range(60):  # each one a little further off, neighbours just linked
        rows.append((i, " ".join(now)))
        at = [(7 * i + 31 * k) % 124 for k in range(3)]
        now = [word() if j in at else w for j, w in enumerate(now)]
    frame = [word() for _ in range(124)]
    for i in range(100, 180):  # one template; a third of its copies have no other copy near
        edits = rng.randint(1, 7)
        at = set(rng.sample(range(124), edits))
        rows.append((i, " ".join(word() if j in at else w for j, w in enumerate(frame))))
    rng.shuffle(rows)
    wanted = least_reachable(rows)
    assert len({c for _, c in wanted.values()}) > 2
    for bound in (150, 1_500):
        found = lsh_forest.near_duplicates(docs(rows), region_shingles=bound).collect()
        assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == wanted


def test_no_documents_no_groups(docs):
    assert lsh_forest.near_duplicates(docs([])).count() == 0


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(200, 201), (7, 7)]
    found = {r["node"]: r["label"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 160)} | {200: 200, 201: 200}


@pytest.mark.parametrize("n,same", [(1, 0), (5, 0), (700, 0), (1500, 800)])
def test_tree_search_is_exact(n, same):
    rng = np.random.default_rng(n)
    vectors = rng.integers(-100, 100, (n, 8)).astype(np.int32)
    vectors[:same] = vectors[0]
    ids = rng.permutation(n) * 3
    tree = mtree.build(ids, vectors, page_rows=32)
    for i in range(0, n, max(1, n // 25)):
        scores = vectors.astype(np.int64) @ vectors[i]
        wanted = sorted((-int(s), int(k)) for s, k in zip(scores, ids) if k != ids[i])[:5]
        found, computed = mtree.search(tree, int(ids[i]), vectors[i], 5)
        assert [(-s, k) for s, k in found] == wanted and computed <= 2 * n + 1


def test_bounds_save_distances():
    rng = np.random.default_rng(1)
    centres = rng.integers(-3000, 3000, (40, 4))
    vectors = (centres[rng.integers(0, 40, 4000)] + rng.integers(-20, 20, (4000, 4))).astype(np.int32)
    tree = mtree.build(np.arange(4000), vectors)
    assert mtree.search(tree, 0, vectors[0], 5)[1] < 2000


def test_top_k_over_trees_and_odd_vectors(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.normal(size=6)]) for i in range(300)]
    rows += [(300, None), (301, [1.0, None]), (302, [float("nan")] * 6), (303, [0.5] * 3), (304, rows[0][1]), (305, rows[0][1]), (None, [1.0] * 6)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = mtree.top_k(df, df.where("vec_id % 50 = 0"), 5, tree_rows=70, block_queries=2).collect()
    usable = {i: np.floor(256 * np.array([np.float32(x) for x in v] + [0.0] * (6 - len(v)), np.float64)).astype(int) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all()}
    wanted = set()
    for q in (i for i in usable if i % 50 == 0):
        best = sorted((-int(usable[q] @ usable[i]), i) for i in usable if i != q)[:5]
        wanted |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(best)}
    assert {(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in found} == wanted
    assert mtree.top_k(df.where("false"), df, 5).count() == 0


@pytest.mark.parametrize("tree_rows,block_queries", [(10, 3), (150, 1), (1000, 100)])
def test_blocks_meet_trees_without_a_join(spark, tree_rows, block_queries):
    rng = np.random.default_rng(3)
    rows = [(i // 2, [float(x) for x in rng.integers(-2, 3, 4)]) for i in range(300)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = mtree.top_k(df, df.where("vec_id % 5 = 0"), 4, tree_rows=tree_rows, block_queries=block_queries)
    # a join would take a copy of the queries for each tree to the driver: the planner sees one copy
    assert "Join" not in found._jdf.queryExecution().executedPlan().toString()
    vectors = [(i, [int(256 * x) for x in v]) for i, v in rows]
    wanted = []
    for q in range(0, 150, 5):
        own = min((np.array(v, "<i4").tobytes(), v) for i, v in vectors if i == q)[1]
        best = sorted((-sum(a * b for a, b in zip(own, v)), i) for i, v in vectors if i != q)[:4]
        wanted += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    assert sorted(tuple(r) for r in found.collect()) == sorted(wanted)


def test_top_k_with_components_beyond_the_trees(spark):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=4).tolist()) for i in range(120)]
    rows += [(150, [3e5, 1.0, 0.0, 0.0]), (151, [-4e5, 2.0, 0.5, 0.0]), (152, [2.9e5, 1.0]), (200, [5000.0, -1.0, 0.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = mtree.top_k(df, df.where("vec_id % 50 = 0"), 5, tree_rows=40).collect()
    scaled = {i: [int(np.floor(256 * x)) for x in v] for i, v in rows}
    wanted = set()
    for q in (i for i in scaled if i % 50 == 0):
        best = sorted((-sum(a * b for a, b in zip(scaled[q], scaled[i])), i) for i in scaled if i != q)[:5]
        wanted |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(best)}
    assert {(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in found} == wanted


def test_one_id_with_many_texts(docs, monkeypatch):
    staged, plain = {}, lsh_forest.stage

    def counted(df, label):
        made = plain(df, label)
        staged[label] = made.count()
        return made

    monkeypatch.setattr(lsh_forest, "stage", counted)
    texts = [" ".join(f"t{i // 2}w{j}" for j in range(30)) + f" end{i}" for i in range(80)]
    found = lsh_forest.near_duplicates(docs([(7, t) for t in texts])).collect()
    assert len(found) == 80 and all(r["component_id"] == 7 for r in found)
    assert staged["shingle-sets"] <= 80
