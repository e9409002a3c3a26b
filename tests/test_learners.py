from __future__ import annotations

import itertools
import math

import numpy as np
import pytest
from conftest import plan_of
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from wardmill.operators import linear as L
from wardmill.plans import explain as E


def grown(rng, features, depth, at=None, nodes=None):
    """A random tree with covers; features repeat along paths."""
    nodes = [] if nodes is None else nodes
    cover = at or 100.0
    here = len(nodes)
    nodes.append([-1, 0.0, -1, -1, rng.normal(), cover])
    if depth and rng.random() < 0.85:
        part = cover * rng.uniform(0.05, 0.95)
        nodes[here][0], nodes[here][1] = rng.integers(features), rng.normal()
        nodes[here][2] = grown(rng, features, depth - 1, part, nodes)
        nodes[here][3] = grown(rng, features, depth - 1, cover - part, nodes)
    if at is not None:
        return here
    t = np.array(nodes)
    return E.TreeArrays(t[:, 0].astype(int), t[:, 1], t[:, 2].astype(int), t[:, 3].astype(int), t[:, 4], float(rng.uniform(0.2, 2)), t[:, 5])


def known_value(t, x, known, at=0):
    f = t.feature[at]
    if f < 0:
        return t.value[at]
    ways = t.left[at], t.right[at]
    if f in known:
        return known_value(t, x, known, ways[0] if x[f] <= t.threshold[at] else ways[1])
    return sum(t.cover[w] / t.cover[at] * known_value(t, x, known, w) for w in ways)


def enumerated(trees, x):
    """Shapley values over all subsets of features."""
    k, out = len(x), np.zeros(len(x))
    for f in range(k):
        others = [i for i in range(k) if i != f]
        for size in range(k):
            share = math.factorial(size) * math.factorial(k - size - 1) / math.factorial(k)
            for known in itertools.combinations(others, size):
                out[f] += share * sum(t.weight * (known_value(t, x, {*known, f}) - known_value(t, x, {*known})) for t in trees)
    return out


@pytest.mark.parametrize("seed", range(12))
def test_shapley_values_equal_all_subsets(seed):
    rng = np.random.default_rng(seed)
    trees = [grown(rng, 4, 5) for _ in range(3)]
    x = rng.normal(size=(25, 4))
    got = E.shapley_values(x, trees)
    assert np.abs(got - np.array([enumerated(trees, row) for row in x])).max() < 1e-9
    base = sum(t.weight * known_value(t, x[0], set()) for t in trees)
    assert E.expected_value(trees) == pytest.approx(base)
    assert np.allclose(got.sum(axis=1) + base, [sum(t.weight * known_value(t, row, {0, 1, 2, 3}) for t in trees) for row in x])


def test_shapley_values_in_pieces_and_of_empty_sides(monkeypatch):
    rng = np.random.default_rng(3)
    trees, x = [grown(rng, 3, 4)], rng.normal(size=(50, 3))
    whole = E.shapley_values(x, trees)
    monkeypatch.setattr(E, "CHUNK_ROWS", 7)
    assert np.array_equal(E.shapley_values(x, trees), whole)
    empty = E.TreeArrays(np.array([0, -1, -1]), np.array([0.5, 0, 0]), np.array([1, -1, -1]), np.array([2, -1, -1]), np.array([0, 3.0, 5.0]), 1.0, np.array([10.0, 10, 0]))
    assert E.shapley_values(np.array([[0.0], [1.0]]), [empty]).tolist() == [[0.0], [2.0]]
    assert E.shapley_values(np.zeros((2, 1)), [E.TreeArrays(*(np.array([v]) for v in (-1, 0.0, -1, -1, 7.0)), 1.0, np.array([5.0]))]).tolist() == [[0.0], [0.0]]


def test_trained_trees_add_up(spark):
    rng = np.random.default_rng(0)
    data = [(float(a), float(b), float(c), float(a * 2 + (b > 0) * c)) for a, b, c in rng.normal(size=(600, 3))]
    df = VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(spark.createDataFrame(data, "a double, b double, c double, y double"))
    model = GBTRegressor(featuresCol="features", labelCol="y", maxIter=5, maxDepth=4, seed=1, subsamplingRate=0.8).fit(df)
    trees = E.tree_arrays(model)
    assert all((t.cover[t.feature >= 0] == t.cover[t.left[t.feature >= 0]] + t.cover[t.right[t.feature >= 0]]).all() for t in trees)
    scored = E.with_shapley_contributions(model.transform(df), model, ["a", "b", "c"])
    total = F.aggregate("contributions", F.lit(0.0), lambda s, x: s + x["value"])
    worst = scored.select(F.max(F.abs(total + F.lit(E.expected_value(trees)) - F.col("prediction")))).first()[0]
    assert worst < 1e-9
    first = scored.first()
    want = enumerated(trees, np.array([first["a"], first["b"], first["c"]]))
    assert np.allclose([e["value"] for e in first["contributions"]], want, atol=1e-9)


def table(spark, x, y, w=None, parts=7):
    columns = [f"x{i}" for i in range(x.shape[1])]
    data = [(*map(float, row), float(v), float(1 if w is None else u)) for row, v, u in zip(x, y, y if w is None else w)]
    return spark.createDataFrame(data, ", ".join(f"{n} double" for n in (*columns, "y", "w"))).repartition(parts), columns


@pytest.mark.parametrize("penalty", [0.0, 0.3])
def test_ridge_equals_numpy(spark, penalty):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(500, 4)) * [1, 10, 0.1, 5] + 1e5
    y, w = x @ [1, -2, 3, 0.5] + rng.normal(size=500), rng.uniform(0, 3, 500)
    df, names = table(spark, x, y, w)
    for weight, own in ((None, np.ones(500)), ("w", w)):
        got = L.fit_ridge(df, names, "y", penalty, weight)
        mean, my = own @ x / own.sum(), own @ y / own.sum()
        cov = ((x - mean) * own[:, None]).T @ (x - mean) / own.sum()
        want = np.linalg.solve(cov + penalty * np.eye(4), ((x - mean) * own[:, None]).T @ (y - my) / own.sum())
        assert np.allclose(got.coefficients, want, rtol=1e-8, atol=1e-9) and got.n == 500
        assert got.intercept == pytest.approx(my - want @ mean, rel=1e-8)
    scored = df.select(F.max(F.abs(got.score() - (F.lit(got.intercept) + sum(F.lit(k) * F.col(n) for n, k in zip(names, got.coefficients)))))).first()[0]
    assert scored < 1e-6


def test_ridge_of_collinear_constant_and_null_columns(spark):
    rng = np.random.default_rng(2)
    a, b = rng.normal(size=200), rng.normal(size=200)
    x = np.column_stack([a, np.full(200, 7.0), 2 * a - 3 * b, b, a])
    y = 3 * a + b
    df, names = table(spark, x, y)
    found = L.fit_ridge(df, names, "y")
    assert found.coefficients[1] == 0 and found.coefficients[3] == 0 and found.coefficients[4] == 0
    assert np.allclose(x @ found.coefficients + found.intercept, y)
    holes = df.withColumns({"x0": F.when(F.col("x0") > 1, None).otherwise(F.col("x0")), "x3": F.when(F.col("x3") > 1, float("nan")).otherwise(F.col("x3"))})
    kept = (a <= 1) & (b <= 1)
    assert L.fit_ridge(holes, ["x0", "x3"], "y").n == kept.sum()
    assert np.allclose(L.fit_ridge(holes, ["x0", "x3"], "y").coefficients, [3, 1])
    with pytest.raises(ValueError, match="no row"):
        L.fit_ridge(df.limit(0), names, "y")
    assert L.fit_ridge(df, [], "y").intercept == pytest.approx(y.mean())


def test_ridge_is_one_scan_and_independent_of_merging(spark, folder):
    rng = np.random.default_rng(3)
    df, names = table(spark, rng.normal(size=(400, 2)), rng.normal(size=400))
    df.write.parquet(f"{folder}/t")
    rows = spark.read.parquet(f"{folder}/t")
    store = spark._jsparkSession.sharedState().statusStore()
    before = store.executionsCount()
    one = L.fit_ridge(rows, names, "y")
    assert store.executionsCount() == before + 1
    assert plan_of(rows).count("FileScan") == 1
    assert L.fit_ridge(rows, names, "y") == one
    assert np.allclose(L.fit_ridge(rows.coalesce(1), names, "y").coefficients, one.coefficients)


@pytest.mark.parametrize("penalty", [0.0, 0.05])
def test_logistic_is_at_its_optimum(spark, penalty):
    """The slope of the penalised loss is zero there."""
    rng = np.random.default_rng(5)
    x = rng.normal(size=(800, 3)) * [1, 2, 0.5]
    y = (rng.random(800) < 1 / (1 + np.exp(-(x @ [1, -0.5, 0] + 0.3)))).astype(float)
    w = np.where(y == 1, 3.0, 1.0)
    df, names = table(spark, x, y, w)
    found = L.fit_logistic(df, names, "y", penalty, "w")
    p = 1 / (1 + np.exp(-(x @ found.coefficients + found.intercept)))
    slope = ((w * (p - y)) @ x) / w.sum() + penalty * np.array(found.coefficients)
    assert np.abs(slope).max() < 1e-8 and abs((w * (p - y)).sum()) < 1e-6
    got = df.select(F.avg(found.probability())).first()[0]
    assert got == pytest.approx(p.mean())
    alone = L.fit_logistic(df.filter("y = 1"), names, "y", 0.1, steps=5)
    assert all(math.isfinite(v) for v in (*alone.coefficients, alone.intercept))
