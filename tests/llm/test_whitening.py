from __future__ import annotations

import numpy as np
import pytest

from llm_fixtures import table  # noqa: F401

from wardmill.llm import whitening
from wardmill.llm.whitening import Spectrum, rank_one


@pytest.mark.parametrize("seed", range(40))
def test_rank_one_updates(seed):
    """Random, repeated and widely spread eigenvalues; rows inside one eigenvector, tiny and huge parts."""
    rng = np.random.default_rng(seed)
    k = int(rng.integers(1, 40))
    values = np.sort(rng.choice([0.0, 1.0, 1.0, 2.0, 1e-8, 5.0, 1e6], k) if seed % 2 else rng.exponential(1, k) * 10.0 ** rng.integers(-6, 6))
    vectors = np.linalg.qr(rng.normal(size=(k, k)))[0]
    row = [rng.normal(size=k) * 10.0 ** rng.integers(-8, 4), vectors[:, 0] * 3, vectors @ (rng.normal(size=k) * 10.0 ** rng.integers(-12, 3, size=k)), np.zeros(k)][seed % 4]
    want = vectors @ np.diag(values) @ vectors.T + np.outer(row, row)
    d, q = rank_one(values, vectors, row)
    size = max(np.abs(want).max(), 1e-300)
    assert np.abs(q @ np.diag(d) @ q.T - want).max() <= 1e-12 * size
    assert np.abs(q.T @ q - np.eye(k)).max() <= 1e-13
    assert np.abs(d - np.linalg.eigvalsh(want)).max() <= 1e-12 * size


def test_spectra_by_rows_by_chunks_and_merged():
    rng = np.random.default_rng(1)
    rows = (rng.normal(size=(300, 12)) * np.linspace(1, 90, 12)).astype(np.int64) + 1_000_000
    apart = rows - rows.mean(axis=0)
    want = apart.T @ apart
    one, many, left, right = (Spectrum.empty(12) for _ in range(4))
    for row in rows:
        one = one.with_rows(row[None, :])
    many = many.with_rows(rows)
    both = left.with_rows(rows[:37]).merged(right.with_rows(rows[37:]))
    for found in (one, many, both):
        assert np.abs(found.vectors @ np.diag(found.values) @ found.vectors.T - want).max() <= 1e-11 * np.abs(want).max()
        assert found.sums() == [int(x) for x in rows.sum(axis=0)] and found.n == 300
    assert Spectrum.empty(12).merged(many) is many and many.merged(Spectrum.empty(12)) is many


def brute(vectors):
    x = np.floor(64 * np.array(vectors, dtype=np.float64)).astype(np.int64) + 1_000_000
    n, sums = len(x), x.sum(axis=0)
    y = (n * x - sums) / n
    values, directions = np.linalg.eigh(y.T @ y / n)
    return n, ((n * x - sums) ** 2).sum(axis=1), y, values[::-1], directions[:, ::-1]


def checked(rows, vectors_of, components):
    """Rows of the result against the eigendecomposition of the whole covariance."""
    ids = sorted(vectors_of)
    n, deviation, y, values, directions = brute([vectors_of[i] for i in ids])
    got = {(r["id"], r["component"]): r for r in rows}
    assert len(got) == len(rows) == len(ids) * components
    for c in range(1, components + 1):
        own = np.array([got[i, c]["whitened"] for i in ids])
        want = y @ directions[:, c - 1] / np.sqrt(values[c - 1])
        assert min(np.abs(own - want).max(), np.abs(own + want).max()) < 1e-9
        for at, i in enumerate(ids):
            assert got[i, c]["n"] == n and got[i, c]["deviation"] == deviation[at]
            assert abs(got[i, c]["explained"] - values[c - 1] / values.sum()) < 1e-12


DDL = "vec_id long, embedding array<float>, id string, n int"


@pytest.mark.parametrize("chunk_rows", [1, 8192])
def test_equal_to_the_whole_eigendecomposition(table, chunk_rows):
    """Unusable vectors are dropped, other lengths too, repeated rows count; columns named as the result's do no harm."""
    rng = np.random.default_rng(3)
    good = {i: [float(np.float32(v)) for v in rng.normal(size=6) * np.arange(1, 7)] for i in range(60)}
    good |= {100 + i: good[0] for i in range(30)}
    bad = [(200, None), (201, []), (202, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (203, [float("nan")] * 6), (204, [float("inf")] * 6), (205, [1.0] * 5), (206, [3e38] * 6)]
    vectors = table([(i, v, "x", 1) for i, v in [*good.items(), *bad]], DDL, parts=20)
    model = whitening.fit(vectors, components=4, chunk_rows=chunk_rows)
    checked(whitening.whitened_rows(vectors, model).collect(), good, 4)
    assert whitening.identity_error(vectors, model) < 1e-10


def test_components_without_variance_are_left_out(table):
    vectors = table([(i, [float(i), 2.0 * i, 1.0], "", 0) for i in range(10)], DDL)
    model = whitening.fit(vectors)
    assert len(model.variances) == 1
    assert whitening.whitened_rows(vectors, model).count() == 10


@pytest.mark.parametrize("rows", [[], [(1, [1.0, 2.0], "", 0)], [(1, [1.0, 2.0], "", 0)] * 3, [(1, None, "", 0)]])
def test_nothing_to_fit(table, rows):
    vectors = table(rows, DDL)
    assert whitening.fit(vectors) is None
    assert whitening.whitened_rows(vectors, None).collect() == []


def test_deviation_that_fits_no_long_is_null():
    model = whitening.Whitening(10 ** 9, [10 ** 15], np.eye(1), np.ones(1), 1.0)
    assert model.deviations(np.array([[1_000_002], [1_000_004]])).to_pylist() == [4 * 10 ** 18, None]


def test_given_vectors(spark):
    from wardmill.llm.queries import QUERIES

    rows = [r.asDict() | {"id": r["vec_id"]} for r in QUERIES["op13_secular_whitening"](spark, "/root/testdata/sf0.001").collect()]
    given = {r["vec_id"]: r["embedding"] for r in spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").collect()}
    checked(rows, given, 32)
    assert max(r["identity_error"] for r in rows) < 1e-10
