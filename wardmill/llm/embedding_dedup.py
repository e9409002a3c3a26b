"""Near-duplicate vectors by randomised-rotation binary codes.

Codes. A unit vector is carried by one random isometry into ``bits`` dimensions and keeps the signs there. With the code x'
(signs over the root of ``bits``) goes the correction factor f = <x', rotated x>. Then <x', rotated y> / f is an unbiased
estimate of <x, y>, with a deviation of sqrt((1 - f*f) / f*f) / sqrt(bits - 1); ``SIGMAS`` of these bound it.

Search. Vectors of one label and length meet if they agree on all bits of a band. Bits agree with probability
1 - angle / pi. The bits of a band follow from the largest label's size, so that unlike vectors meet rarely, and the
number of bands from the bits, so that a pair at the threshold misses every band with probability ``MISS``. Large buckets
are cut into cells. In a cell, pairs whose upper bound is below the threshold are done; all others are recomputed exactly in
double precision. A pair that meets in several bands counts in the first. Equal vectors are one node with a multiplicity.
A cell returns counts of links and a spanning forest, so a group of n like vectors gives n rows, not n * n.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardmill.llm.cells import cells, complete_groups
from wardmill.llm.graph import connected_components
from wardmill.llm.shared import stored

COSINE = 0.98
SIGMAS = 5.0
MISS = 1e-5
#: Unlike vectors that share a bucket, on average.
BUCKET = 1 / 8
CELL = 1500
SEED = 7

_ROTATIONS: dict[tuple[int, int], np.ndarray] = {}


def rotation(length: int, bits: int) -> np.ndarray:
    """A random isometry: ``bits`` x ``length``, orthonormal columns."""
    if (length, bits) not in _ROTATIONS:
        draw = np.random.default_rng([SEED, length, bits]).standard_normal((bits, length))
        q, r = np.linalg.qr(draw)
        _ROTATIONS[length, bits] = q * np.sign(np.diag(r))
    return _ROTATIONS[length, bits]


def bands_for(largest: int, cosine: float, miss: float = MISS) -> tuple[int, int]:
    """Bits of a band and number of bands."""
    width = max(8, math.ceil(math.log2(max(largest, 1) / BUCKET)))
    agree = (1 - math.acos(cosine) / math.pi) ** width
    return width, max(1, math.ceil(math.log(miss) / math.log(1 - agree)))


def _matrix(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Flat values in double precision, row bounds, and which rows have only finite components and a length above zero."""
    lengths = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    values = column.flatten()
    gaps = values.is_null().to_numpy(zero_copy_only=False)
    values = values.cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False)
    bounds = np.concatenate([[0], np.cumsum(lengths)])
    good = np.isfinite(values) & ~gaps
    row = np.repeat(np.arange(len(lengths)), lengths)
    bad = np.bincount(row, weights=~good, minlength=len(lengths)) > 0
    top = np.zeros(len(lengths))
    np.maximum.at(top, row, np.where(good, np.abs(values), 0))
    return values, bounds, ~bad & (top > 0)


def _unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)      # squares of extreme values neither over- nor underflow
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def _coded(width: int, bands: int, kind: type):
    def run(batches):
        for batch in batches:
            values, bounds, good = _matrix(batch.column(batch.schema.get_field_index("vector")))
            lengths = np.diff(bounds)
            for length in np.unique(lengths[good]):
                some = np.flatnonzero(good & (lengths == length))
                raw = values[bounds[some][:, None] + np.arange(length)]
                unit = _unit(raw)
                bits = -(-max(width * bands, int(length)) // 64) * 64
                turned = unit @ rotation(int(length), bits).T
                signs = turned > 0
                factor = np.abs(turned).sum(axis=1) / math.sqrt(bits)
                value = signs[:, :width * bands].reshape(len(some), bands, width) @ (1 << np.arange(width, dtype=np.int64))
                take = pa.array(some)
                yield pa.RecordBatch.from_arrays([
                    *(batch.column(batch.schema.get_field_index(n)).take(take) for n in ("node", "copies", "label")),
                    pa.array(np.full(len(some), length, dtype=np.int32)), pa.array([v.tobytes() for v in raw.astype(kind)], type=pa.binary()),
                    pa.array([v.tobytes() for v in np.packbits(signs, axis=1)], type=pa.binary()), pa.array(factor),
                    pa.ListArray.from_arrays(pa.array(np.arange(len(some) + 1, dtype=np.int32) * bands), pa.array(value.ravel())),
                ], names=["node", "copies", "label", "length", "raw", "code", "factor", "bands"])

    return run


def _compared(cosine: float, width: int, bands: int, kind: type):
    def run(batches):
        for table, bounds in complete_groups(batches):
            ids, copies, band, factor = (table.column(n).to_numpy() for n in ("node", "copies", "band", "factor"))
            alone, block = table.column("alone").to_numpy(), table.column("block").to_numpy()
            units, codes = table.column("raw").to_pylist(), table.column("code").to_pylist()
            out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
            for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                if not alone[a] and block[a] == block[b - 1] and (block[a:b] == block[a]).all():
                    continue
                unit = _unit(np.frombuffer(b"".join(units[a:b]), dtype=kind).reshape(b - a, -1).astype(np.float64))
                packed = np.frombuffer(b"".join(codes[a:b]), dtype=np.uint8).reshape(b - a, -1)
                signs = np.unpackbits(packed, axis=1).astype(np.float64)
                bits = signs.shape[1]
                back = ((2 * signs - 1) / math.sqrt(bits)) @ rotation(unit.shape[1], bits)
                f = factor[a:b]
                bound = SIGMAS * np.sqrt(np.maximum(1 - f * f, 0)) / f / math.sqrt(bits - 1)
                open_ = (back @ unit.T) / f[:, None] + bound[:, None] >= cosine
                open_ = np.triu(open_, 1)
                if not alone[a]:
                    open_ &= block[a:b, None] != block[None, a:b]
                i, j = np.nonzero(open_)
                exact = np.concatenate([np.einsum("nd,nd->n", unit[i[s:s + 20_000]], unit[j[s:s + 20_000]]) for s in range(0, len(i), 20_000)] or [np.zeros(0)])
                i, j = i[exact >= cosine], j[exact >= cosine]
                if not len(i):
                    continue
                value = signs[:, :width * bands].reshape(b - a, bands, width)[:, :band[a]] @ (1 << np.arange(width))
                fresh = np.ones(len(i), dtype=bool)
                for earlier in range(int(band[a])):
                    fresh &= value[i, earlier] != value[j, earlier]
                n, own = b - a, copies[a:b]
                links = np.bincount(i[fresh], weights=own[j[fresh]], minlength=n) + np.bincount(j[fresh], weights=own[i[fresh]], minlength=n)
                root = np.arange(n)
                while True:                       # smallest member that links reach inside the cell
                    least = root.copy()
                    np.minimum.at(least, i, root[j])
                    np.minimum.at(least, j, root[i])
                    least = least[least]
                    if (least == root).all():
                        break
                    root = least
                some = np.flatnonzero((links > 0) | (root != np.arange(n)))
                out.append((ids[a + some], links[some].astype(np.int64), ids[a + root[some]]))
            columns = [np.concatenate([x[k] for x in out]) if out else np.zeros(0, dtype=np.int64) for k in range(3)]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=["node", "links", "near"])

    return run


def near_duplicate_vectors(rows: DataFrame, *, id_: str = "vec_id", vector: str = "embedding", label: str = "label", cosine: float = COSINE, cell: int = CELL) -> DataFrame:
    """``id``, ``n_links``, ``component_id``, ``kept`` for each row.

    Vectors link when their labels are equal and not null, their lengths are equal and their cosine is at least ``cosine``.
    A vector that is null, empty, zero or holds a null or non-finite component links with nothing, nor does a row without
    an id (component null, kept). Repeated rows are vectors of their own and share their id's component.
    """
    kind = np.float32 if rows.select(vector).dtypes[0][1] == "array<float>" else np.float64
    rows = rows.select(F.col(id_).cast("long").alias("id"), F.col(label).cast("string").alias("label"), F.col(vector).cast("array<double>").alias("vector"))
    keyed = rows.where("id is not null and label is not null and size(vector) > 0").withColumns({
        "h1": F.xxhash64("label", "vector"), "h2": F.xxhash64(F.lit(1), "vector", "label")})
    nodes = stored(keyed.groupBy(F.col("h1").alias("node"), "h2").agg(
        F.min("id").alias("id"), F.count(F.lit(1)).alias("copies"), F.first("label").alias("label"), F.first("vector").alias("vector")), "vectors")
    largest = nodes.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    width, bands = bands_for(largest, cosine)
    coded = stored(nodes.select("node", "copies", "label", "vector").mapInArrow(_coded(width, bands, kind),
                   "node long, copies long, label string, length int, raw binary, code binary, factor double, bands array<long>"), "codes")
    meeting = coded.select("node", "label", "length", F.posexplode("bands").alias("band", "value"))
    meeting = meeting.select(F.xxhash64("label", "length", "band", "value").alias("bucket"), "node", "band")
    payload = coded.select("node", "copies", "raw", "code", "factor")
    found = stored(cells(meeting, "bucket", "node", cell, payload).mapInArrow(_compared(cosine, width, bands, kind), "node long, links long, near long"), "vector-links")
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    classes = connected_components(found, "node", "near")
    good = coded.select("node", "copies").join(nodes.select("node", "id"), "node").join(counts, "node", "left").join(classes, "node", "left")
    good = good.select("node", "id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"), F.coalesce("component", "node").alias("class"))
    smallest = good.groupBy("class").agg(F.min("id").alias("component"))
    good = good.join(smallest, "class").select("node", "links", "component")
    linked = keyed.select("id", F.col("h1").alias("node")).join(good, "node").groupBy("id").agg(F.max("links").alias("links"), F.min("component").alias("component"))
    return rows.select("id").join(linked, "id", "left").select(
        "id", F.coalesce("links", F.lit(0)).alias("n_links"), F.coalesce("component", "id").alias("component_id"),
        F.coalesce(F.coalesce("component", "id") == F.col("id"), F.lit(True)).alias("kept"))
