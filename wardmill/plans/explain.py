"""Contributions of features to the prediction of a boosted-tree regressor.

Shapley values: a feature's share is its mean effect over all orders in which features become known; a split on an unknown
feature takes both ways, weighted by the training rows that went there. Along a path only two things of a feature count: the
part of rows that would follow the path without it, and whether this row does. Subsets of equal size are therefore the
coefficients of a product of one linear factor for each feature of the path, which is extended on the way down and divided by a
feature's factor at the leaf. That takes steps in the order of leaves times depth squared, exact for any number of features.

Path contributions: each split a row passes moves the expected value from the node to the chosen child; that step belongs to
the split's feature. Cheaper; totals agree with the Shapley values, shares can differ.

The trees are a few thousand nodes fixed by the training parameters, never by
the data, so they travel as plain arrays inside the closure; rows are processed
in Arrow batches where Spark put them.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardmill.session import importable_in_tasks


@dataclass(frozen=True)
class TreeArrays:
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    weight: float
    cover: np.ndarray | None = None


def tree_arrays(model: GBTRegressionModel) -> list[TreeArrays]:
    trees = []
    for tree, weight in zip(model._java_obj.trees(), model.treeWeights):
        nodes: list[list[float]] = []
        pending = [(tree.rootNode(), None, None)]
        while pending:
            node, parent, side = pending.pop()
            at = len(nodes)
            nodes.append([-1, 0.0, -1, -1, node.prediction(), float(node.impurityStats().count())])
            if parent is not None:
                nodes[parent][side] = at
            if node.subtreeDepth() > 0:
                split = node.split()
                nodes[at][0], nodes[at][1] = split.featureIndex(), split.threshold()
                pending += [(node.leftChild(), at, 2), (node.rightChild(), at, 3)]
        table = np.array(nodes, dtype=float)
        trees.append(TreeArrays(
            table[:, 0].astype(int), table[:, 1], table[:, 2].astype(int), table[:, 3].astype(int), table[:, 4],
            float(weight), table[:, 5],
        ))
    return trees


def path_contributions(x: np.ndarray, trees: list[TreeArrays]) -> np.ndarray:
    """One row per input row, one column per feature."""
    rows = np.arange(len(x))
    out = np.zeros_like(x, dtype=float)
    for t in trees:
        at = np.zeros(len(x), dtype=int)
        while True:
            inner = t.feature[at] >= 0
            if not inner.any():
                break
            active, here = rows[inner], at[inner]
            f = t.feature[here]
            below = np.where(x[active, f] <= t.threshold[here], t.left[here], t.right[here])
            np.add.at(out, (active, f), t.weight * (t.value[below] - t.value[here]))
            at[inner] = below
    return out


#: Rows that are explained at once, whatever the batch.
CHUNK_ROWS = 4096


def _extended(poly: np.ndarray, part: float, follows: np.ndarray) -> np.ndarray:
    """Coefficients times ``part + follows y``."""
    out = np.zeros((len(poly) + 1, poly.shape[1]))
    out[:-1] = poly * part
    out[1:] += poly * follows
    return out


def _divided(poly: np.ndarray, part: float, follows: np.ndarray) -> np.ndarray:
    """Coefficients divided by ``part + follows y``: from the top where the row follows, else by the constant."""
    out = np.empty((len(poly) - 1, poly.shape[1]))
    rest = poly[-1]
    for k in range(len(out) - 1, -1, -1):
        out[k] = rest
        rest = poly[k] - part * rest
    return np.where(follows, out, poly[:-1] / part if part > 0 else 0.0)


def _tree_shapley(x: np.ndarray, t: TreeArrays, out: np.ndarray) -> None:
    size = int(t.feature.max(initial=-1)) + 1
    orders = [np.array([math.factorial(k) * math.factorial(d - 1 - k) / math.factorial(d) for k in range(d)]) for d in range(1, size + 1)]

    def down(at: int, poly: np.ndarray, path: dict[int, tuple[float, np.ndarray]]) -> None:
        f = int(t.feature[at])
        if f < 0:
            for feature, (part, follows) in path.items():
                share = orders[len(path) - 1] @ _divided(poly, part, follows)
                out[:, feature] += t.weight * t.value[at] * share * (follows - part)
            return
        below = x[:, f] <= t.threshold[at]
        before = path.get(f)
        if before is not None:
            poly = _divided(poly, *before)
        for child, goes in ((int(t.left[at]), below), (int(t.right[at]), ~below)):
            part = t.cover[child] / t.cover[at] if t.cover[at] > 0 else 0.0
            if before is not None:
                part, goes = part * before[0], goes & before[1]
            down(child, _extended(poly, part, goes), {**path, f: (part, goes)})

    down(0, np.ones((1, len(x))), {})


def shapley_values(x: np.ndarray, trees: list[TreeArrays]) -> np.ndarray:
    """One row per input row, one column per feature."""
    out = np.zeros_like(x, dtype=float)
    for i in range(0, len(x), CHUNK_ROWS):
        for t in trees:
            _tree_shapley(x[i:i + CHUNK_ROWS], t, out[i:i + CHUNK_ROWS])
    return out


def expected_value(trees: list[TreeArrays]) -> float:
    """Mean prediction, leaves weighted by their training rows: the base that Shapley values add up from."""
    total = 0.0
    for t in trees:
        share = np.zeros(len(t.value))
        share[0] = 1.0
        for at in np.flatnonzero(t.feature >= 0):             # parents come before their children
            for child in (t.left[at], t.right[at]):
                share[child] = share[at] * t.cover[child] / t.cover[at] if t.cover[at] > 0 else 0.0
        total += t.weight * float((share * t.value)[t.feature < 0].sum())
    return total


def explained_column(vectors: Column, trees: list[TreeArrays], method: Callable[[np.ndarray, list[TreeArrays]], np.ndarray]) -> Column:
    """Contributions of an array of features; only this array goes to Python, as an Arrow list column."""
    @F.pandas_udf("array<double>")
    def explained(rows: pd.Series) -> pd.Series:
        if not len(rows):
            return pd.Series([], dtype=object)
        return pd.Series(list(method(np.stack(rows.to_numpy()), trees)))

    return explained(vectors)


def _with_contributions(scored: DataFrame, trees: list[TreeArrays], base: float, method, features: list[str]) -> DataFrame:
    importable_in_tasks(scored.sparkSession)
    names = F.array(*[F.lit(n) for n in features])
    values = scored.withColumn("_values", explained_column(vector_to_array("features"), trees, method))
    return values.withColumns({
        "contributions": F.zip_with(
            names, "_values", lambda n, v: F.struct(n.alias("feature"), v.alias("value"))
        ),
        "shap_base_value": F.round(F.lit(base), 4),
    }).drop("_values", "features")


def with_shapley_contributions(scored: DataFrame, model: GBTRegressionModel, features: list[str]) -> DataFrame:
    """Adds ``contributions`` (array of feature and Shapley value) and ``shap_base_value``, the mean prediction."""
    trees = tree_arrays(model)
    return _with_contributions(scored, trees, expected_value(trees), shapley_values, features)


def with_path_contributions(scored: DataFrame, model: GBTRegressionModel, features: list[str]) -> DataFrame:
    """Adds ``contributions`` (array of feature and path step) and ``shap_base_value``, the value of the roots."""
    trees = tree_arrays(model)
    return _with_contributions(scored, trees, float(sum(t.weight * t.value[0] for t in trees)), path_contributions, features)
