"""Whitening of vectors by an incremental eigendecomposition.

Every partition keeps the spectrum of the scatter of the rows it has read. New rows enter as centred rank-one updates: in the
known eigenbasis each is a diagonal matrix plus one outer product, whose eigenvalues are the roots of the secular equation
and whose eigenvectors follow from them, after equal eigenvalues and vanishing parts are deflated. Rows are taken in chunks: an
orthogonal transformation turns the chunk's centred rows into at most as many rows as there are dimensions, with the same
scatter, and each of those is one update, as is the shift of the mean (``chunk_rows=1``: one update for each row of the table).
Spectra of partitions are combined by updating one with the other's eigenpairs and the shift, in rounds of a few spectra
a group. At last a pass over all rows projects the exactly centred data on the basis found, and the Ritz vectors
of that projection are the components.

What moves is one spectrum for each partition, of the dimensions squared, whatever the number of rows. Sums are exact integers.

Defined results: rows whose vector is null, empty, holds a null or non-finite entry, or an entry whose grid value
needs more than 53 bits have no result; if lengths differ, rows of the most frequent length count (of the longest at a tie).
A component without variance cannot be scaled and is left out, so a constant table, a single row and an empty table give no rows.
Repeated ids and rows count as rows. ``deviation`` is null where the exact sum does not fit a long.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardmill.llm.shared import stored

COMPONENTS = 32
#: Grid of the entries.
STEP, SHIFT = 64, 1_000_000
CHUNK_ROWS = 8192
#: Entries of a chunk in memory, whatever the dimensions.
CHUNK_ENTRIES = 1 << 21
#: Spectra combined in one task.
TOGETHER = 16
_EPS = float(np.finfo(np.float64).eps)
_HALF = np.int64(32)


# --- rank-one updates ---------------------------------------------------------------

def secular_roots(d: np.ndarray, z: np.ndarray, steps: int = 80) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of ``diag(d) + z z'`` for rising, distinct ``d`` and no zero in ``z``.

    Each is given as the number of its nearest pole and the distance from it, so that differences to poles keep their digits.
    """
    k, squares = len(d), z * z
    total = squares.sum()
    last = np.arange(k) == k - 1
    width = np.append(np.diff(d), total)
    middle = 1 + (squares / (d[None, :] - (d + width / 2)[:, None])).sum(axis=1)
    pole = np.where((middle < 0) & ~last, np.minimum(np.arange(k) + 1, k - 1), np.arange(k))
    from_right = pole != np.arange(k)
    low = np.where(from_right, -width / 2, 0.0)
    high = np.where(from_right, 0.0, np.where(last, width, width / 2))
    high = np.where(last & (middle < 0), width, np.where(last, width / 2, high))
    low = np.where(last & (middle < 0), width / 2, low)
    delta = d[None, :] - d[pole][:, None]
    left = np.tri(k, dtype=bool)
    at = (low + high) / 2
    first, second = delta[np.arange(k), np.arange(k)], delta[np.arange(k), np.minimum(np.arange(k) + 1, k - 1)]
    open_ = np.ones(k, dtype=bool)
    for _ in range(steps):
        o = np.flatnonzero(open_)
        apart = delta[o] - at[o, None]
        terms = squares / apart
        value = 1 + terms.sum(axis=1)
        slopes = terms / apart
        below, above = np.where(left[o], slopes, 0).sum(axis=1), np.where(left[o], 0, slopes).sum(axis=1)
        high[o], low[o] = np.where(value >= 0, at[o], high[o]), np.where(value < 0, at[o], low[o])
        one, two = first[o] - at[o], second[o] - at[o]
        with np.errstate(all="ignore"):
            c = value - one * below - two * above
            a = (one + two) * value - one * two * (below + above)
            b = one * two * value
            root = np.sqrt(np.maximum(a * a - 4 * b * c, 0))
            step = np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))
            step = np.where(last[o], one + below * one * one / (value - one * below), step)
            new = at[o] + step
        inside = np.isfinite(new) & (new > low[o]) & (new < high[o])
        new = np.where(inside, new, (low[o] + high[o]) / 2)
        done = (np.abs(value) <= 2 * _EPS * (1 + np.abs(terms).sum(axis=1))) | (np.abs(new - at[o]) <= _EPS * np.abs(new))
        at[o] = np.where(done & ~inside, at[o], new)
        open_[o[done]] = False
        if not open_.any():
            break
    return pole, at


def rank_one(values: np.ndarray, vectors: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (rising) and eigenvectors (columns) after ``row row'`` is added to the matrix that they belong to."""
    z = vectors.T @ row
    weight = float(z @ z)
    if weight == 0:
        return values, vectors
    tiny = 8 * _EPS * max(float(values[-1]), weight)
    vectors = vectors.copy()
    bounds = np.flatnonzero(np.append(True, np.diff(values) > tiny))
    for a, b in zip(bounds, np.append(bounds[1:], len(values)), strict=True):
        if b - a > 1:                                      # equal eigenvalues: turn their space until one vector has all of the row
            part = z[a:b]
            length = float(np.linalg.norm(part))
            if length:
                target = -length if part[-1] >= 0 else length
                mirror = part.copy()
                mirror[-1] -= target
                mirror /= np.linalg.norm(mirror)
                vectors[:, a:b] -= 2 * np.outer(vectors[:, a:b] @ mirror, mirror)
                z[a:b] = 0
                z[b - 1] = target
    moved = np.flatnonzero(np.abs(z) * np.sqrt(weight) > tiny)
    if not len(moved):
        return values, vectors
    d, part = values[moved], z[moved]
    k = len(d)
    pole, at = secular_roots(d, part)
    apart = (d[pole][:, None] - d[None, :]) + at[:, None]          # root j less pole i
    j, i = np.arange(k)[:, None], np.arange(k)[None, :]
    with np.errstate(all="ignore"):
        below = np.where(j < i, d[:, None] - d[None, :], np.append(d[1:], 0.0)[:, None] - d[None, :])
        below[-1] = 1.0
        exact = np.sqrt(np.abs(np.prod(apart / below, axis=0))) * np.where(part >= 0, 1.0, -1.0)
        turned = exact[:, None] / -apart.T
        turned /= np.linalg.norm(turned, axis=0)
    values = values.copy()
    values[moved] = d[pole] + at
    vectors[:, moved] = vectors[:, moved] @ turned
    order = np.argsort(values, kind="stable")
    return values[order], vectors[:, order]


@dataclass
class Spectrum:
    """Rows, exact sums of the entries (in two halves), eigenvalues and eigenvectors of their scatter."""

    n: int
    high: np.ndarray
    low: np.ndarray
    values: np.ndarray
    vectors: np.ndarray

    @classmethod
    def empty(cls, dimensions: int) -> Spectrum:
        zeros = np.zeros(dimensions, dtype=np.int64)
        return cls(0, zeros, zeros, np.zeros(dimensions), np.eye(dimensions))

    def sums(self) -> list[int]:
        return [(int(h) << 32) + int(w) for h, w in zip(self.high, self.low, strict=True)]

    def mean(self) -> np.ndarray:
        return (self.high.astype(np.longdouble) * 4294967296 + self.low.astype(np.longdouble)) / self.n

    def with_rows(self, rows: np.ndarray) -> Spectrum:
        """``rows``: integers, a chunk."""
        high, low = (rows >> _HALF).sum(axis=0), (rows & np.int64(0xFFFFFFFF)).sum(axis=0)
        own = Spectrum(len(rows), high + (low >> _HALF), low & np.int64(0xFFFFFFFF), np.zeros(0), np.zeros((0, 0)))
        if len(rows) > 1:
            centred = (rows - rows[0]) - (own.mean() - rows[0]).astype(np.float64)
            reduced = np.linalg.qr(centred, mode="r")
        else:
            reduced = np.zeros((0, rows.shape[1]))
        return self._and(own, reduced)

    def merged(self, other: Spectrum) -> Spectrum:
        if not self.n or not other.n:
            return self if other.n == 0 else other
        there = other.values > 0
        return self._and(other, np.sqrt(other.values[there])[:, None] * other.vectors[:, there].T)

    def _and(self, other: Spectrum, updates: np.ndarray) -> Spectrum:
        values, vectors = self.values, self.vectors
        for row in updates:
            values, vectors = rank_one(values, vectors, row)
        if self.n:
            share = np.sqrt(self.n / (self.n + other.n) * other.n)
            values, vectors = rank_one(values, vectors, (share * (other.mean() - self.mean())).astype(np.float64))
        low = self.low + other.low
        return Spectrum(self.n + other.n, self.high + other.high + (low >> _HALF), low & np.int64(0xFFFFFFFF), values, vectors)

    def packed(self) -> tuple:
        return self.n, self.high.tobytes(), self.low.tobytes(), self.values.tobytes(), np.ascontiguousarray(self.vectors).tobytes()

    @classmethod
    def unpacked(cls, n: int, high: bytes, low: bytes, values: bytes, vectors: bytes) -> Spectrum:
        k = len(values) // 8
        return cls(n, np.frombuffer(high, np.int64), np.frombuffer(low, np.int64), np.frombuffer(values), np.frombuffer(vectors).reshape(k, k))


@dataclass
class Moments:
    """Rows, means and centred products of projected rows."""

    n: int
    mean: np.ndarray
    products: np.ndarray

    @classmethod
    def empty(cls, dimensions: int) -> Moments:
        return cls(0, np.zeros(dimensions), np.zeros((dimensions, dimensions)))

    def with_rows(self, rows: np.ndarray) -> Moments:
        mean = rows.mean(axis=0)
        return self.merged(Moments(len(rows), mean, (rows - mean).T @ (rows - mean)))

    def merged(self, other: Moments) -> Moments:
        n = self.n + other.n
        if not self.n or not other.n:
            return self if other.n == 0 else other
        apart = other.mean - self.mean
        return Moments(n, self.mean + apart * (other.n / n), self.products + other.products + np.outer(apart, apart) * (self.n / n * other.n))

    def packed(self) -> tuple:
        return self.n, self.mean.tobytes(), self.products.tobytes()

    @classmethod
    def unpacked(cls, n: int, mean: bytes, products: bytes) -> Moments:
        k = len(mean) // 8
        return cls(n, np.frombuffer(mean), np.frombuffer(products).reshape(k, k))


_KINDS = {Spectrum: ("n", "high", "low", "vals", "vecs"), Moments: ("n", "mean", "products")}


def _schema(kind: type) -> str:
    return "part int, " + ", ".join(f"{c} {'long' if c == 'n' else 'binary'}" for c in _KINDS[kind])


def _record(kind: type, part: int, state) -> pa.RecordBatch:
    types = [pa.int32(), *(pa.int64() if c == "n" else pa.binary() for c in _KINDS[kind])]
    return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip((part, *state.packed()), types, strict=True)], names=["part", *_KINDS[kind]])


# --- rows ------------------------------------------------------------------------------

def usable(column: pa.Array) -> np.ndarray:
    """Which rows have a vector of finite entries that fit the grid."""
    lengths = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    flat = column.flatten()
    entries = flat.to_numpy(zero_copy_only=False).astype(np.float64) if len(flat) else np.zeros(0)
    with np.errstate(invalid="ignore"):
        bad = ~(np.abs(entries) * STEP < float(1 << 52))
    if flat.null_count:
        bad |= flat.is_null().to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(column)), lengths)
    return (lengths > 0) & (np.bincount(row[bad], minlength=len(column)) == 0)


def grid(column: pa.Array, dimensions: int, chunk_rows: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and grid values of the usable rows of a length, a chunk at a time."""
    lengths = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    good = np.flatnonzero(usable(column) & (lengths == dimensions))
    size = max(1, min(chunk_rows, CHUNK_ENTRIES // dimensions))
    for i in range(0, len(good), size):
        at = good[i:i + size]
        entries = column.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        yield at, np.floor(entries * STEP).astype(np.int64).reshape(-1, dimensions) + np.int64(SHIFT)


def _lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found: dict[int, int] = {}
    for batch in batches:
        column = batch.column(0)
        for k, n in zip(*np.unique(column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)[usable(column)], return_counts=True), strict=True):
            found[int(k)] = found.get(int(k), 0) + int(n)
    yield pa.RecordBatch.from_arrays([pa.array(found.keys(), pa.int32()), pa.array(found.values(), pa.int64())], names=["length", "n"])


def _of_partitions(vectors: DataFrame, kind: type, dimensions: int, size: int, chunk_rows: int, project: Callable[[np.ndarray], np.ndarray] | None = None) -> DataFrame:
    """One state for each partition with rows, then combined in rounds to one row."""

    def state(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        own, kept, n = kind.empty(size), [], 0
        for batch in batches:
            for _, rows in grid(batch.column(0), dimensions, chunk_rows):
                kept.append(rows)
                n += len(rows)
                if n >= min(chunk_rows, max(1, CHUNK_ENTRIES // dimensions)):
                    rows, kept, n = np.concatenate(kept), [], 0
                    own = own.with_rows(rows if project is None else project(rows))
        if kept:
            rows = np.concatenate(kept)
            own = own.with_rows(rows if project is None else project(rows))
        if own.n:
            yield _record(kind, TaskContext.get().partitionId(), own)

    def together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, own = None, None
        for batch in batches:
            for row in batch.to_pylist():
                other = kind.unpacked(*(row[c] for c in _KINDS[kind]))
                if row["into"] != part:
                    if own is not None:
                        yield _record(kind, part, own)
                    part, own = row["into"], other
                else:
                    own = own.merged(other)
        if own is not None:
            yield _record(kind, part, own)

    name = kind.__name__.lower()
    states = stored(vectors.mapInArrow(state, _schema(kind)), name)
    last = states.agg(F.max("part")).first()[0] or 0
    while last:
        groups = states.withColumn("into", (F.col("part") / TOGETHER).cast("int")).repartition("into").sortWithinPartitions("into", "part")
        states = stored(groups.mapInArrow(together, _schema(kind)), name)
        last //= TOGETHER
    return states


def _single(states: DataFrame, kind: type, size: int):
    row = states.first()
    return kind.unpacked(*(bytes(row[c]) if c != "n" else row[c] for c in _KINDS[kind])) if row else kind.empty(size)


# --- fit and use ----------------------------------------------------------------------

@dataclass
class Whitening:
    """``directions``: a unit column for each component, by falling ``variances``; ``trace``: all variance."""

    n: int
    sums: list[int]
    directions: np.ndarray
    variances: np.ndarray
    trace: float

    @property
    def dimensions(self) -> int:
        return len(self.sums)

    def centred(self, rows: np.ndarray) -> np.ndarray:
        """Grid values less their mean, the whole part of which is subtracted as an integer."""
        whole = np.array([s // self.n for s in self.sums], dtype=np.int64)
        return (rows - whole) - np.array([s % self.n / self.n for s in self.sums])

    def whitened(self, rows: np.ndarray) -> np.ndarray:
        return self.centred(rows) @ self.directions / np.sqrt(self.variances)

    def deviations(self, rows: np.ndarray) -> pa.Array:
        """Exact sums of (n x - S)^2; differences that fit a long are right whatever their terms overflowed to."""
        rough = (self.centred(rows) ** 2).sum(axis=1) * float(self.n) ** 2
        with np.errstate(over="ignore"):
            sums = np.array([s % (1 << 64) for s in self.sums], dtype=np.uint64).astype(np.int64)
            apart = rows * np.int64(self.n) - sums
            exact = (apart * apart).sum(axis=1)
        return pa.array(exact, mask=rough > 9.2e18)


def fit(vectors: DataFrame, *, vector: str = "embedding", components: int = COMPONENTS, chunk_rows: int = CHUNK_ROWS) -> Whitening | None:
    """Three passes over the column: lengths, spectra, and the Rayleigh-Ritz projection. None if there is nothing to fit."""
    column = vectors.select(F.col(vector).cast("array<double>").alias("vector"))
    lengths = column.mapInArrow(_lengths, "length int, n long").groupBy("length").agg(F.sum("n").alias("n"))
    most = lengths.orderBy(F.desc("n"), F.desc("length")).first()
    if most is None:
        return None
    d = int(most["length"])
    found = _single(_of_partitions(column, Spectrum, d, d, chunk_rows), Spectrum, d)
    basis = np.linalg.qr(found.vectors)[0]
    start = Whitening(found.n, found.sums(), basis, np.ones(d), 0.0)
    ritz = _single(_of_partitions(column, Moments, d, d, chunk_rows, start.whitened), Moments, d)
    values, turned = np.linalg.eigh(ritz.products / ritz.n)
    values, directions = values[::-1], (basis @ turned)[:, ::-1]
    kept = min(components, int((values > _EPS * d * max(values[0], 0.0) * 8).sum()))
    return Whitening(found.n, start.sums, directions[:, :kept], values[:kept], float(np.trace(ritz.products) / ritz.n)) if kept else None


def identity_error(vectors: DataFrame, model: Whitening, *, vector: str = "embedding", chunk_rows: int = CHUNK_ROWS) -> float:
    """Largest absolute entry of the whitened rows' covariance less the identity."""
    column, k = vectors.select(F.col(vector).cast("array<double>").alias("vector")), len(model.variances)
    all_ = _single(_of_partitions(column, Moments, model.dimensions, k, chunk_rows, model.whitened), Moments, k)
    return float(np.abs(all_.products / all_.n - np.eye(k)).max())


_RESULT = "id long, component int, n long, deviation long, whitened double, explained double"


def whitened_rows(vectors: DataFrame, model: Whitening | None, *, id_: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """A row for each usable vector and component: ``id``, ``component`` (from 1), ``n``, ``deviation``, ``whitened``, ``explained``."""
    spark = vectors.sparkSession
    if model is None:
        return spark.createDataFrame([], _RESULT)
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        k = len(m.variances)
        for batch in batches:
            for at, rows in grid(batch.column(1), m.dimensions, CHUNK_ROWS):
                every = pa.array(np.repeat(np.arange(len(at)), k))
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).take(pa.array(at)).take(every), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(at))),
                    pa.array(np.full(len(at) * k, m.n)), m.deviations(rows).take(every),
                    pa.array(m.whitened(rows).ravel()), pa.array(np.tile(m.variances / m.trace, len(at))),
                ], names=["id", "component", "n", "deviation", "whitened", "explained"])

    return vectors.select(F.col(id_).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector")).mapInArrow(run, _RESULT)
