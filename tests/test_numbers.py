import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from agora.functions.numbers import natural_log, score_from_log
from agora.operators import distributions, metrics, quantiles, trends
from agora.operators.quantiles import exact_percentiles
from agora.plans.evaluations import compare_models


def test_log_edges(frame):
    df = frame([(0,), (-3,), (None,), (1,), (20,)], "score long")
    got = [r[0] for r in df.select(natural_log(F.col("score"))).collect()]
    assert got[0] == -math.inf and math.isnan(got[1]) and got[2] is None
    assert got[3:] == [0.0, pytest.approx(math.log(20))]


def test_predicted_score_truncates(frame):
    df = frame([(math.log(2.7),), (-1.0,), (float("nan"),), (1000.0,), (None,)], "p double")
    got = [r[0] for r in df.select(score_from_log(F.col("p"))).collect()]
    assert got == [2, 0, None, None, None]


def test_metrics_divide_by_all_rows(frame):
    rows = [("a", 1.0, 2.0), ("a", 3.0, 3.5), ("a", None, 1.0), ("a", 2.0, None), ("b", 1.0, 4.0),
            ("b", 2.0, 4.0)]
    df = frame(rows, "split string, log_score double, predictions double")
    got = {r["split"]: r for r in metrics.metrics_by_split(df).collect()}
    assert got["a"]["baseline_rmse"] == pytest.approx(math.sqrt(2.0 / 4))
    assert got["a"]["model_rmse"] == pytest.approx(math.sqrt((1 + 0.25) / 4))
    assert got["a"]["num_rows"] == 4
    assert got["a"]["model_correlation"] == pytest.approx(1.0)
    # Constant predictions have no correlation and must not fail the query.
    assert math.isnan(got["b"]["model_correlation"])


def test_eval_metrics_skip_nan(frame):
    rows = [(1.0, 2.0), (2.0, float("nan")), (float("nan"), 1.0), (4.0, 4.0), (None, 3.0)]
    got = metrics.eval_metrics(frame(rows, "y double, p double"), "y", "p").first()
    assert got["rmse"] == pytest.approx(math.sqrt(0.5))
    assert got["correlation"] == pytest.approx(1.0)


def test_compare_models(frame):
    df = frame([("t", 1.0, 1.0), ("t", 2.0, 2.0)], "split string, log_score double, predictions double")
    off = df.withColumn("predictions", F.col("predictions") + 1)
    got = {r["model"]: r["model_rmse"] for r in compare_models({"good": df, "off": off}).collect()}
    assert got == {"good": 0.0, "off": 1.0}


def test_correct_compares_nan_as_largest_and_keeps_null(frame):
    nan = float("nan")
    rows = [(nan, 1.0), (1.0, nan), (None, 1.0), (2.0, 1.0), (1.0, 1.0)]
    df = metrics.with_correct(frame(rows, "chosen_reward double, rejected_reward double"))
    assert [r["correct"] for r in df.collect()] == [True, False, None, True, False]
    assert metrics.pair_accuracy(df).first()[0] == pytest.approx(50.0)


def test_linear_fit_and_range(frame):
    df = frame([(float(i), 2.0 * i + 1) for i in range(10)], "x double, y double")
    fit = metrics.linear_fit(df, "x", "y").first()
    assert (fit["slope"], fit["intercept"], fit["r_value"]) == pytest.approx((2.0, 1.0, 1.0))
    assert tuple(metrics.joint_range(df, "x", "y").first()) == (0.0, 19.0)


@pytest.mark.parametrize("seed", [1, 2])
def test_histogram_matches_numpy(frame, seed):
    rng = np.random.default_rng(seed)
    values = rng.normal(size=500).round(3).tolist()
    got = {r["bin"]: r["count"] for r in
           distributions.histogram(frame([(v,) for v in values], "x double"), "x").collect()}
    want, _ = np.histogram(values, bins=20)
    assert [got.get(i + 1, 0) for i in range(20)] == want.tolist()


def test_histogram_of_one_value_and_of_infinities(frame):
    same = distributions.histogram(frame([(3.0,)] * 5, "x double"), "x").collect()
    want, _ = np.histogram([3.0] * 5, bins=20)
    assert [(r["bin"], r["count"]) for r in same] == [(int(want.argmax()) + 1, 5)]
    odd = frame([(1.0,), (2.0,), (-math.inf,), (float("nan"),), (None,)], "x double")
    assert sum(r["count"] for r in distributions.histogram(odd, "x").collect()) == 2


def test_histogram_by_uses_each_groups_range(frame):
    rows = [("a", 0.0), ("a", 1.0), ("b", 100.0), ("b", 300.0), (None, 5.0)]
    got = distributions.histogram_by(frame(rows, "g string, x double"), "g", "x", 2).collect()
    assert {(r["g"], r["bin"], r["count"]) for r in got} == {
        ("a", 1, 1), ("a", 2, 1), ("b", 1, 1), ("b", 2, 1), (None, 2, 1)
    }


def test_density_grid_leaves_out_points_outside(frame):
    rows = [(0.0, 0.0), (1.0, 1.0), (0.4, 0.9), (2.0, 0.5), (float("nan"), 0.5)]
    got = distributions.density_grid(frame(rows, "x double, y double"), "x", "y", 0, 1, 2).collect()
    assert {(r["x_bin"], r["y_bin"], r["count"]) for r in got} == {(1, 1, 1), (2, 2, 1), (1, 2, 1)}


@pytest.mark.parametrize("kind", ["smooth", "copies", "wide", "few"])
def test_percentiles_match_numpy(frame, kind):
    rng = random.Random(kind)
    make = {
        "smooth": lambda: rng.gauss(0, 1),
        "copies": lambda: rng.choice([1.0, 1.0, 1.0, 2.0, 1e-9]),
        "wide": lambda: math.copysign(10 ** rng.uniform(-12, 12), rng.random() - 0.5),
        "few": lambda: rng.random(),
    }[kind]
    groups = {"a": [make() for _ in range(3 if kind == "few" else 2000)], "b": [make()], None: [make(), make()]}
    rows = [(g, v) for g, values in groups.items() for v in values] + [("a", None)]
    probs = [0.0, 0.05, 0.5, 0.95, 1.0]
    got = exact_percentiles(frame(rows, "g string, x double"), ["g"], "x", probs).collect()
    for row in got:
        want = np.percentile(groups[row["g"]], [p * 100 for p in probs])
        assert list(row)[1:] == pytest.approx(want.tolist(), rel=1e-12)
    assert len(got) == 3


def test_percentiles_of_nothing_and_of_nan(frame):
    df = frame([("a", float("nan")), ("a", 1.0), ("b", None)], "g string, x double")
    got = exact_percentiles(df, ["g"], "x", [0.5]).collect()
    assert len(got) == 1 and math.isnan(got[0]["p0"])
    assert exact_percentiles(df.where("false"), ["g"], "x", [0.5]).collect() == []
    assert exact_percentiles(df.where("false"), [], "x", [0.5]).collect()[0]["p0"] is None


def test_summaries(frame):
    values = [1.0, 2.0, 3.0, 10.0]
    got = distributions.distribution_summary(frame([(v,) for v in values], "r double"), "r").first()
    assert got["mean"] == 4.0 and got["median"] == 2.5
    assert got["std_dev"] == pytest.approx(np.std(values))
    assert (got["p5"], got["p95"]) == pytest.approx(tuple(np.percentile(values, [5, 95])))
    maps = frame([({"a": 1.0, "b": 5.0},), ({"a": 3.0},)], "m map<string,double>")
    rows = {r["metric"]: r for r in distributions.metric_summaries(maps, "m").collect()}
    assert rows["a"]["mean"] == 2.0 and rows["b"]["median"] == 5.0


def test_value_counts(frame):
    df = frame([("x",), ("x",), (None,)], "v string")
    got = [tuple(r) for r in trends.value_counts(df, "v", pct=True).collect()]
    assert got == [("x", 2, 66.67), (None, 1, 33.33)]


def test_percentiles_with_infinities_and_far_ends(frame):
    inf = float("inf")
    groups = {
        "low": [-inf, 2.0, 3.0, 4.0],
        "both": [-inf, -inf, 0.0, inf, inf],
        "far": [-1e308, -1.0, 0.0, 1.0, 1e308],
        "tiny": [5e-324, 1e-323, 1.0],
        "nan": [1.0, float("nan"), inf],
        "only": [inf, inf],
        "none": [None],
    }
    rows = [(g, v) for g, values in groups.items() for v in values]
    got = exact_percentiles(frame(rows, "g string, x double"), ["g"], "x", [0.0, 0.5, 1.0]).collect()
    found = {r["g"]: (r["p0"], r["p1"], r["p2"]) for r in got}
    assert found["low"] == (-inf, 2.5, 4.0)
    assert found["both"] == (-inf, 0.0, inf)
    assert found["far"] == (-1e308, 0.0, 1e308)
    assert found["tiny"] == (5e-324, 1e-323, 1.0)
    assert all(str(x) == "nan" for x in found["nan"])
    assert found["only"] == (inf, inf, inf)
    assert "none" not in found


def test_percentiles_of_many_groups(spark):
    df = spark.range(150_000).selectExpr("id % 50000 as g", "cast(id as double) as x")
    got = exact_percentiles(df, ["g"], "x", [0.5])
    assert got.count() == 50_000 and got.where("p0 <> g + 50000").count() == 0


def test_percentiles_take_two_passes(spark, monkeypatch):
    staged, plain = [], quantiles.stage
    monkeypatch.setattr(quantiles, "stage", lambda df, label: staged.append(label) or plain(df, label))
    rows = spark.range(400_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 7).cast("string")).alias("g"),
        F.when(F.col("id") % 5 == 0, 7.0).otherwise(F.pmod(F.xxhash64("id"), F.lit(10**9)) / 1e4).alias("x"),
    )
    probs = [0.0, 0.0003, 0.05, 0.2, 0.5, 0.95, 0.9999, 1.0]
    got = {r["g"]: r for r in exact_percentiles(rows, ["g"], "x", probs).collect()}
    assert staged == ["values", "spans"]  # the third and last job reads the result
    groups = {}
    for g, x in rows.collect():
        groups.setdefault(g, []).append(x)
    assert set(got) == set(groups)
    for g, values in groups.items():
        assert [got[g][f"p{i}"] for i in range(len(probs))] == pytest.approx(list(np.quantile(values, probs)), abs=0, rel=1e-12)


def test_percentiles_of_a_group_around_the_size_of_a_summary(spark):
    for n in (9_999, 10_000, 10_001, 10_003):
        rows = spark.range(n).select((F.col("id") * 7919 % n).cast("double").alias("x"))
        probs = [k / 997 for k in range(0, 998, 83)]
        got = exact_percentiles(rows, [], "x", probs).first()
        assert list(got) == pytest.approx([p * (n - 1) for p in probs])


def test_kernel_density_matches_the_sums_over_all_rows(spark):
    rng = np.random.default_rng(3)
    x = np.append(rng.normal(2, 1, 600), 2.2)
    y = np.append(0.6 * x[:600] + rng.normal(1, 0.5, 600), 1.0)
    rows = [(float(a), float(b)) for a, b in zip(x, y)] + [(None, 1.0), (1.0, float("nan")), (float("inf"), 2.0)]
    df = spark.createDataFrame(rows, "x double, y double")
    found = {(r["x_point"], r["y_point"]): r["density"] for r in distributions.density_kernel(df, "x", "y", 0, 6, 120).collect()}
    shape = np.cov(x, y) * len(x) ** (-1 / 3)
    inverse, norm = np.linalg.inv(shape), 2 * np.pi * math.sqrt(np.linalg.det(shape)) * len(x)
    worst = 0.0
    for i in range(0, 121, 8):
        for j in range(0, 121, 8):
            gap = np.stack([i * 0.05 - x, j * 0.05 - y])
            wanted = np.exp(-0.5 * (gap * (inverse @ gap)).sum(axis=0)).sum() / norm
            worst = max(worst, abs(found.get((i, j), 0.0) - wanted))
    assert worst < 2e-3  # the peak is about 0.2; binning rounds rows to a grid of 0.05
    assert sum(found.values()) * 0.05**2 == pytest.approx(np.mean([(0 <= a <= 6) and (0 <= b <= 6) for a, b in zip(x, y)]), abs=0.03)


def test_no_density_without_a_full_covariance(spark):
    for rows in ([], [(1.0, 2.0)], [(1.0, 2.0), (2.0, 4.0), (3.0, 6.0)], [(1.0, 1.0), (1.0, 2.0)]):
        df = spark.createDataFrame(rows, "x double, y double")
        assert distributions.density_kernel(df, "x", "y", 0, 6).collect() == []
