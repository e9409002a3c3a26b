"""Exact ridge and logistic regression from aggregated products.

A fit needs no more of the data than the weighted means and centred products of its columns. Every partition adds up
its own, a fixed number of tasks merges them, and only matrices of the features squared reach the driver, where the system
is solved by Cholesky elimination. A ridge fit is one scan; a logistic fit is one scan for each reweighting.

Rows with a null or non-finite value in a used column are left out, as SQL's aggregates over complete rows do. A column that
is constant, or a combination of the columns before it, gets the coefficient 0 unless a penalty decides.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardmill.session import importable_in_tasks

#: Tasks that merge the partitions' sums, and so the matrices that the driver adds up.
MERGERS = 64
#: Part of a column's own variance that must be left when the columns before it are taken out.
COLLINEAR = 1e-9


@dataclass(frozen=True)
class Products:
    """Rows, sum of weights, weighted means and centred products."""

    n: int
    weight: float
    mean: np.ndarray
    products: np.ndarray

    @classmethod
    def of(cls, x: np.ndarray, w: np.ndarray) -> Products:
        total = float(w.sum())
        if not total:
            return cls(len(x), 0.0, np.zeros(x.shape[1]), np.zeros((x.shape[1], x.shape[1])))
        mean = w @ x / total
        apart = x - mean
        return cls(len(x), total, mean, (apart * w[:, None]).T @ apart)

    def merged(self, other: Products) -> Products:
        weight = self.weight + other.weight
        if not self.weight or not other.weight:
            kept = self if self.weight else other
            return Products(self.n + other.n, weight, kept.mean, kept.products)
        apart = other.mean - self.mean
        return Products(self.n + other.n, weight, self.mean + apart * (other.weight / weight),
                        self.products + other.products + np.outer(apart, apart) * (self.weight / weight * other.weight))


_STATE = "part int, n long, weight double, mean binary, products binary"


def _row(part: int, p: Products) -> pa.RecordBatch:
    values = [(part, pa.int32()), (p.n, pa.int64()), (p.weight, pa.float64()), (p.mean.tobytes(), pa.binary()), (p.products.tobytes(), pa.binary())]
    return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in values], names=["part", "n", "weight", "mean", "products"])


def _products(row: dict) -> Products:
    mean = np.frombuffer(row["mean"])
    return Products(row["n"], row["weight"], mean, np.frombuffer(row["products"]).reshape(len(mean), len(mean)))


def products(df: DataFrame, columns: Sequence[str], weight: str | None = None,
             change: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]] | None = None) -> Products | None:
    """Sums of the columns in one scan; ``change`` maps a batch's values and weights to others first. None without a complete row."""
    importable_in_tasks(df.sparkSession)
    used = [*columns, *([weight] if weight else [])]
    complete = F.lit(True)
    for n in used:
        value = F.col(n).cast("double")
        complete = complete & value.isNotNull() & ~F.isnan(value) & (F.abs(value) < float("inf"))
    rows = df.filter(complete).select(*[F.col(n).cast("double").alias(f"c{i}") for i, n in enumerate(used)])
    k = len(columns)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = None
        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns[:k]], axis=1)
            w = batch.column(k).to_numpy(zero_copy_only=False) if weight else np.ones(len(x))
            if change is not None:
                x, w = change(x, w)
            here = Products.of(x, w)
            own = here if own is None else own.merged(here)
        if own is not None:
            yield _row(TaskContext.get().partitionId(), own)

    def together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = None
        for batch in batches:
            for row in batch.to_pylist():
                own = _products(row) if own is None else own.merged(_products(row))
        if own is not None:
            yield _row(TaskContext.get().partitionId(), own)

    states = rows.mapInArrow(partial, _STATE).repartition(MERGERS, "part").sortWithinPartitions("part").mapInArrow(together, _STATE)
    total = None
    for row in sorted((r.asDict() for r in states.collect()), key=lambda r: r["part"]):
        total = _products(row) if total is None else total.merged(_products(row))
    return total


def solved(a: np.ndarray, b: np.ndarray, own: np.ndarray) -> np.ndarray:
    """``a x = b`` for a positive semidefinite matrix, column by column; ``own``: the variances that decide what is left of a column."""
    k = len(b)
    lower, used = np.zeros((k, k)), np.zeros(k, dtype=bool)
    for j in range(k):
        rest = a[j, j] - lower[j, :j] @ lower[j, :j]
        used[j] = rest > COLLINEAR * own[j] and own[j] > 0
        if used[j]:
            lower[j, j] = np.sqrt(rest)
            lower[j + 1:, j] = (a[j + 1:, j] - lower[j + 1:, :j] @ lower[j, :j]) / lower[j, j]
    y, x = np.zeros(k), np.zeros(k)
    for j in np.flatnonzero(used):
        y[j] = (b[j] - lower[j, :j] @ y[:j]) / lower[j, j]
    for j in np.flatnonzero(used)[::-1]:
        x[j] = (y[j] - lower[j + 1:, j] @ x[j + 1:]) / lower[j, j]
    return x


@dataclass(frozen=True)
class LinearModel:
    """``intercept + sum of coefficient * column``; ``n``: the rows that it was fitted on."""

    features: tuple[str, ...]
    coefficients: tuple[float, ...]
    intercept: float
    n: int

    def score(self) -> Column:
        """A plain expression; null where a feature is."""
        out = F.lit(self.intercept)
        for name, k in zip(self.features, self.coefficients, strict=True):
            out = out + F.lit(k) * F.col(name).cast("double")
        return out

    def probability(self) -> Column:
        return 1.0 / (1.0 + F.exp(-self.score()))

    def terms(self, df: DataFrame) -> DataFrame:
        """``term`` and ``coefficient``, the intercept first."""
        rows = [("intercept", float(self.intercept)), *zip(self.features, map(float, self.coefficients), strict=True)]
        return df.sparkSession.createDataFrame(rows, "term string, coefficient double")


def _ridge(p: Products, penalty: float, n: int, features: Sequence[str]) -> LinearModel:
    cov = p.products / p.weight
    k = len(features)
    own = np.diag(cov)[:k] + penalty
    coefficients = solved(cov[:k, :k] + penalty * np.eye(k), cov[:k, k], own)
    return LinearModel(tuple(features), tuple(coefficients.tolist()), float(p.mean[k] - coefficients @ p.mean[:k]), n)


def fit_ridge(df: DataFrame, features: Sequence[str], target: str, penalty: float = 0.0, weight: str | None = None) -> LinearModel:
    """Least weighted mean of squared errors plus ``penalty`` times the squared coefficients; the intercept is free."""
    p = products(df, [*features, target], weight)
    if p is None or not p.weight:
        raise ValueError(f"no row has all of {[*features, target]}")
    return _ridge(p, penalty, p.n, features)


def fit_logistic(df: DataFrame, features: Sequence[str], label: str, penalty: float = 0.0, weight: str | None = None,
                 steps: int = 30, tolerance: float = 1e-10) -> LinearModel:
    """Least weighted mean of logistic losses plus half of ``penalty`` times the squared coefficients, by iterated reweighting.

    Each step is a weighted ridge fit of the working response. If labels can be told apart without error and there is no penalty, no
    finite optimum exists and the steps end at ``steps``; so they do with one label only. Cache ``df`` if its lineage is long.
    """
    k = len(features)
    now = np.zeros(k + 1)
    total, model = 0.0, None
    for step in range(steps):
        def working(x: np.ndarray, w: np.ndarray, at: np.ndarray = now) -> tuple[np.ndarray, np.ndarray]:
            line = np.clip(at[0] + x[:, :k] @ at[1:], -30, 30)
            p = 1 / (1 + np.exp(-line))
            curve = p * (1 - p)
            return np.column_stack([x[:, :k], line + (x[:, k] - p) / curve]), w * curve

        p = products(df, [*features, label], weight, working)
        if p is None or not p.weight:
            raise ValueError(f"no row has all of {[*features, label]}")
        total = total or 4 * p.weight                # at zero every curve is a quarter
        model = _ridge(p, penalty * total / p.weight, p.n, features)
        new = np.array([model.intercept, *model.coefficients])
        done = np.abs(new - now).max() <= tolerance * (1 + np.abs(new).max())
        now = new
        if done:
            break
    return model
