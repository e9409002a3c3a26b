"""Near-duplicate documents: improved consistent weighted sampling over TF-IDF shingles.

Weights. A shingle is five successive words (all words of a shorter text). Its weight is ``1 + ln(tf)`` times an inverse
document frequency between 1 and ``1 + IDF_RISE``: 1 for a shingle of every document, the most for one in less than
``COMMON`` of them. Frequencies are exact and over all documents; only shingles of at least that share need a table, and
there are at most (shingles of the mean document) / ``COMMON`` of them, which bounds what is broadcast. The rise is mild
on purpose: in a large family of near copies the shared shingles are the frequent ones, and a steep one would hide them.

Sampling. For each of ``BANDS * ROWS`` hashes, a shingle S of weight w gets r ~ Gamma(2, 1), c ~ Gamma(2, 1), b ~ U(0, 1),
t = floor(ln w / r + b), ln y = r (t - b), ln a = ln c - ln y - r; the sample is (S, t) of the smallest a. Two texts agree
on a sample with a probability equal to their weighted Jaccard similarity. With 10 bands of 3 a pair at 0.8 shares a band
with probability 0.9992, one at 0.9 with 0.999998.

Search. Texts of equal words are one node from here on. Nodes that meet in a band and agree on ``AGREE`` of 30 samples
(a pair at 0.8 fails that with probability 5e-5) are candidates; a spanning forest of them in each bucket suffices to
bring all candidates into one group. The texts of a group then meet once, and candidates are verified by exact weighted
Jaccard similarity, best first; pairs that verified links connect already aren't computed again. Large buckets and groups
are cut into cells (``cells``). Classes are the components of verified links.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardmill.llm.cells import cells, complete_groups, linked_pairs, spanning_links
from wardmill.llm.graph import connected_components
from wardmill.llm.shared import stored
from wardmill.llm.words import grams, mix, row_grams, scan

SHINGLE = 5
SIMILARITY = 0.8
COMMON = 0.02
IDF_RISE = 0.25
BANDS, ROWS = 10, 3
AGREE = 14
CELL = 1000
_SUMMARY = 1 << 20

_HASHES = BANDS * ROWS
_SEEDS = mix(np.arange(1, _HASHES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _gamma_quantiles(bits: int = 16) -> np.ndarray:
    """Quantiles of Gamma(2, 1), whose distribution function is 1 - (1 + x) exp(-x), by bisection."""
    p = (np.arange(1 << bits) + 0.5) / (1 << bits)
    low, high = np.zeros_like(p), np.full_like(p, 50.0)
    for _ in range(60):
        middle = (low + high) / 2
        below = 1 - (1 + middle) * np.exp(-middle) < p
        low, high = np.where(below, middle, low), np.where(below, high, middle)
    return (low + high) / 2


_TABLES: dict[str, np.ndarray] = {}


def _tables() -> tuple[np.ndarray, np.ndarray]:
    if not _TABLES:
        gamma = _gamma_quantiles()
        _TABLES["r"], _TABLES["ln_c"] = gamma.astype(np.float32), np.log(gamma).astype(np.float32)
    return _TABLES["r"], _TABLES["ln_c"]


# --- shingles and their weights -------------------------------------------------------------------------------------


def row_shingles(piece, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each row of a piece, sorted by row and hash: hashes, rows, times."""
    found, rows = row_grams(piece.hashes(), piece.first, k)
    order = np.lexsort((found, rows))
    found, rows = found[order], rows[order]
    new = np.ones(len(found), dtype=bool)
    new[1:] = (found[1:] != found[:-1]) | (rows[1:] != rows[:-1])
    at = np.flatnonzero(new)
    return found[at], rows[at], np.diff(np.append(at, len(found)))


def _column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def _counted(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    unique, inverse = np.unique(keys, return_inverse=True)
    return unique, np.bincount(inverse, weights=counts, minlength=len(unique)).astype(np.int64)


def _local_counts(text: str, k: int, share: float, summary: int):
    """Of each run of rows: its documents with words (as shingle null), and the shingles in more than ``share`` of them.

    A run ends where its distinct shingles pass ``summary``, which bounds memory. What a run leaves out is in at most ``share``
    of its own documents, so the sum over all runs misses at most ``share`` of all documents, wherever runs end.
    """

    def run(batches):
        keys, counts, documents = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64), 0
        waiting: list[np.ndarray] = []

        def merged():
            fresh, times = np.unique(np.concatenate(waiting), return_counts=True) if waiting else (keys[:0], counts[:0])
            waiting.clear()
            return _counted(np.concatenate([keys, fresh]), np.concatenate([counts, times]))

        def told():
            keep = counts > share * documents
            found, times = keys[keep], counts[keep]
            yield pa.RecordBatch.from_arrays([pa.array([None], type=pa.int64()), pa.array([documents], type=pa.int64())], names=["shingle", "n"])
            for at in range(0, len(found), 100_000):
                yield pa.RecordBatch.from_arrays([pa.array(found[at:at + 100_000].view(np.int64)), pa.array(times[at:at + 100_000])], names=["shingle", "n"])

        for batch in batches:
            for piece in scan(_column(batch, text)):
                found, _, _ = row_shingles(piece, k)
                documents += int((np.diff(piece.first) > 0).sum())
                waiting.append(found)
                if sum(map(len, waiting)) > summary:
                    keys, counts = merged()
                    if len(keys) > summary:
                        yield from told()
                        keys, counts, documents = keys[:0], counts[:0], 0
        keys, counts = merged()
        yield from told()

    return run


def _exact_counts(text: str, k: int, wanted):
    def run(batches):
        keys = wanted.value
        counts = np.zeros(len(keys) + 1, dtype=np.int64)
        for batch in batches:
            for piece in scan(_column(batch, text)):
                found, _, _ = row_shingles(piece, k)
                at = np.searchsorted(keys, found)
                known = keys[np.minimum(at, len(keys) - 1)] == found
                counts += np.bincount(at[known], minlength=len(counts))
        some = np.flatnonzero(counts[:-1])
        yield pa.RecordBatch.from_arrays([pa.array(keys[some].view(np.int64)), pa.array(counts[some])], names=["shingle", "n"])

    return run


def common_shingles(docs: DataFrame, text: str = "text", k: int = SHINGLE, common: float = COMMON, summary: int = _SUMMARY) -> tuple[np.ndarray, np.ndarray]:
    """Hashes, sorted, of the shingles in at least ``common`` of the documents with words, and those shares, exact.

    First pass: counts of what more than a quarter of that share of the documents of a run of rows hold. Their sums miss at
    most a quarter of the share, so what reaches three quarters includes every common shingle and is bounded. Second
    pass: exact counts of these.
    """
    spark = docs.sparkSession
    local = stored(docs.select(text).mapInArrow(_local_counts(text, k, common / 4, summary), "shingle long, n long"), "shingle-counts")
    documents = local.where("shingle is null").agg(F.sum("n")).first()[0] or 0
    likely = local.where("shingle is not null").groupBy("shingle").agg(F.sum("n").alias("n")).where(F.col("n") >= 0.75 * common * documents)
    keys = np.sort(likely.select("shingle").toArrow().column(0).to_numpy().view(np.uint64))
    if not len(keys) or not documents:
        return np.zeros(0, dtype=np.uint64), np.zeros(0)
    counts = docs.select(text).mapInArrow(_exact_counts(text, k, spark.sparkContext.broadcast(keys)), "shingle long, n long")
    exact = counts.groupBy("shingle").agg(F.sum("n").alias("n")).where(F.col("n") >= common * documents).toArrow()
    keys, shares = exact.column(0).to_numpy().view(np.uint64), exact.column(1).to_numpy() / documents
    order = np.argsort(keys)
    return keys[order], shares[order]


def weights(found: np.ndarray, times: np.ndarray, table: tuple[np.ndarray, np.ndarray], common: float = COMMON, rise: float = IDF_RISE) -> np.ndarray:
    keys, shares = table
    out = np.full(len(found), 1 + rise)
    if len(keys):
        at = np.minimum(np.searchsorted(keys, found), len(keys) - 1)
        known = keys[at] == found
        out[known] = 1 + rise * np.log(np.minimum(shares[at[known]], 1)) / np.log(common)
    return out * (1 + np.log(times))


# --- sampling -------------------------------------------------------------------------------------------------------


def samples(found: np.ndarray, weight: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Consistent weighted samples: for each row (a range of ``found`` from each start on) ``_HASHES`` 64-bit values."""
    r_table, c_table = _tables()
    ln_w = np.log(weight).astype(np.float32)
    lengths = np.diff(np.append(starts, len(found)))
    out = np.empty((len(starts), _HASHES), dtype=np.uint64)
    places = np.arange(len(found))
    for h in range(_HASHES):
        x = mix(found ^ _SEEDS[h])
        r = r_table[(x & np.uint64(0xFFFF)).astype(np.int64)]
        b = ((x >> np.uint64(16)) & np.uint64(0xFFFF)).astype(np.float32) * np.float32(1 / 65536)
        t = np.floor(ln_w / r + b)
        ln_a = c_table[(x >> np.uint64(48)).astype(np.int64)] - r * (t - b) - r
        least = np.minimum.reduceat(ln_a, starts)
        first = np.minimum.reduceat(np.where(ln_a == np.repeat(least, lengths), places, len(found)), starts)
        out[:, h] = mix(found[first] + t[first].astype(np.int64).astype(np.uint64) * np.uint64(0xA24BAED4963EE407) + _SEEDS[h])
    return out


def _sketched(id_: str, mark: str, text: str, k: int, table):
    def run(batches):
        common = table.value
        for batch in batches:
            ids, marks = _column(batch, id_), _column(batch, mark)
            for piece in scan(_column(batch, text)):
                found, rows, times = row_shingles(piece, k)
                some, starts = np.unique(rows, return_index=True)
                if not len(some):
                    continue
                sample = samples(found, weights(found, times, common), starts)
                bands = [grams(sample.ravel(), ROWS)[i * ROWS::_HASHES] for i in range(BANDS)]
                hashes = piece.hashes()
                words = np.stack([[_whole(hashes[piece.first[r]:piece.first[r + 1]], seed) for r in some] for seed in (1, 3)])
                size = len(some)
                at = pa.array(some + piece.rows.start)
                yield pa.RecordBatch.from_arrays([
                    ids.take(at), marks.take(at),
                    pa.array(words[0].view(np.int64)), pa.array(words[1].view(np.int64)),
                    pa.ListArray.from_arrays(pa.array(np.arange(size + 1, dtype=np.int32) * BANDS), pa.array(np.stack(bands, axis=1).ravel().view(np.int64))),
                    pa.array([row.tobytes() for row in sample.astype(np.uint32)], type=pa.binary()),
                ], names=["id", "t", "w1", "w2", "bands", "sample"])

    return run


def _whole(hashes: np.ndarray, seed: int) -> np.uint64:
    """Hash of a whole word sequence."""
    place = mix(np.arange(len(hashes), dtype=np.uint64) * np.uint64(2) + np.uint64(seed))
    return (mix(hashes ^ place) * (place | np.uint64(1))).sum(dtype=np.uint64)


# --- search ---------------------------------------------------------------------------------------------------------


def _agreement(sample: np.ndarray) -> np.ndarray:
    out = np.zeros((len(sample), len(sample)), dtype=np.uint8)
    for h in range(sample.shape[1]):
        column = sample[:, h]
        out += column[:, None] == column[None, :]
    return out


def _meets(table: pa.Table, a: int, b: int) -> np.ndarray | None:
    """Which pairs a cell of two blocks has to compare."""
    if table.column("alone")[a].as_py():
        return None
    side = table.column("block").to_numpy()[a:b]
    return side[:, None] != side[None, :]


def _samples_of(table: pa.Table) -> np.ndarray:
    return np.frombuffer(b"".join(table.column("sample").to_pylist()), dtype=np.uint32).reshape(table.num_rows, _HASHES)


def _links(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x[i] for x in pairs], type=pa.int64()) for i in (0, 1)], names=["src", "dst"])


def _candidates(batches):
    for table, bounds in complete_groups(batches):
        ids, sample, out = table.column("id").to_numpy(), _samples_of(table), []
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            if b - a == 2:
                if (sample[a] == sample[a + 1]).sum() >= AGREE and (table.column("alone")[int(a)].as_py() or table.column("block")[int(a)] != table.column("block")[int(a) + 1]):
                    out.append((ids[a], ids[a + 1]))
                continue
            i, j = linked_pairs(_agreement(sample[a:b]), AGREE, _meets(table, int(a), int(b)))
            out += [(ids[a + x], ids[a + y]) for x, y in spanning_links(i, j, b - a)]
        yield _links(out)


def _verified(k: int, table_of, similarity: float):
    def run(batches):
        common = table_of.value
        for table, bounds in complete_groups(batches):
            ids, sample, out = table.column("id").to_numpy(), _samples_of(table), []
            for a, b in zip(bounds[:-1], bounds[1:], strict=True):
                shingles: list[tuple[np.ndarray, np.ndarray, float]] = []
                for piece in scan(table.column("text").slice(a, b - a)):
                    found, rows, times = row_shingles(piece, k)
                    weight = weights(found, times, common)
                    ends = np.searchsorted(rows, np.arange(len(piece.first)))
                    shingles += [(found[s:e], weight[s:e], float(weight[s:e].sum())) for s, e in zip(ends[:-1], ends[1:], strict=True)]

                def similar(x, y, shingles=shingles):
                    (p, u, total), (q, v, other) = shingles[x], shingles[y]
                    if min(total, other) < similarity * max(total, other):
                        return False
                    at = np.minimum(np.searchsorted(q, p), len(q) - 1)
                    same = q[at] == p
                    shared = float(np.minimum(u[same], v[at[same]]).sum())
                    return shared >= (similarity - 1e-12) * (total + other - shared)

                i, j = linked_pairs(_agreement(sample[a:b]), AGREE, _meets(table, int(a), int(b)))
                out += [(ids[a + x], ids[a + y]) for x, y in spanning_links(i, j, b - a, similar)]
            yield _links(out)

    return run


def near_duplicates(docs: DataFrame, *, id_: str = "doc_id", text: str = "text", k: int = SHINGLE, similarity: float = SIMILARITY, cell: int = CELL) -> DataFrame:
    """``id``, ``class_id`` (smallest id of the class) and ``kept`` (it is that one), a row for each row of ``docs``.

    Texts without words (null ones, too) and rows without an id are a class of their own; without an id, class_id is null.
    Rows that share an id are one document with several texts: each of these is compared, and all that one of them links
    is of one class. The order of rows and their partitions have no influence.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(id_).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    common = spark.sparkContext.broadcast(common_shingles(docs, "text", k))
    docs = docs.withColumn("t", F.xxhash64("text"))
    sketches = stored(docs.where("id is not null").mapInArrow(_sketched("id", "t", "text", k, common),
                      "id long, t long, w1 long, w2 long, bands array<long>, sample binary"), "sketches")
    # A node is a word sequence (w1, w2); the smallest of its rows (id, t) has the text that stands for it.
    first = F.min(F.struct("id", "t")).alias("own")
    nodes = stored(sketches.groupBy("w1", "w2").agg(first, F.first("bands").alias("bands"), F.first("sample").alias("sample"))
                   .select("w1", "w2", F.col("own.id").alias("node"), F.col("own.t").alias("t"), "bands", "sample"), "nodes")

    meeting = nodes.select("w1", "w2", F.posexplode("bands").alias("band", "value")).select("w1", "w2", F.xxhash64("band", "value").alias("bucket"))
    pairs = cells(meeting, "bucket", ["w1", "w2"], cell, nodes.select("w1", "w2", "sample"))
    pairs = stored(pairs.select("cell", F.col("w1").alias("id"), "block", "alone", "sample").mapInArrow(_candidates, "src long, dst long"), "candidates")
    groups = stored(connected_components(pairs), "groups")

    members = groups.select(F.col("node").alias("w1"), "component").join(nodes.select("w1", "w2", F.col("node").alias("id"), "t", "sample"), "w1")
    members = members.join(docs.where("id is not null").dropDuplicates(["id", "t"]), ["id", "t"])
    texts = cells(members, "component", ["w1", "w2"], cell).select("cell", "id", "block", "alone", "sample", "text")
    links = stored(texts.mapInArrow(_verified(k, common, similarity), "src long, dst long"), "verified")

    nodes_of = stored(sketches.select("id", "w1", "w2").join(nodes.select("w1", "w2", "node"), ["w1", "w2"]).select("id", "node"), "nodes-of")
    several = nodes_of.groupBy("id").agg(F.min("node").alias("src"), F.max("node").alias("last")).where("src < last").select("id", "src")
    same_id = nodes_of.join(several, "id").where("node > src").select("src", F.col("node").alias("dst"))
    classes = connected_components(links.union(same_id))

    per_id = nodes_of.join(classes, "node", "left").groupBy("id").agg(F.min(F.coalesce("component", "node")).alias("class_id"))
    return docs.select("id").join(per_id, "id", "left").select(
        "id", F.coalesce("class_id", "id").alias("class_id"), F.coalesce(F.coalesce("class_id", "id") == F.col("id"), F.lit(True)).alias("kept"))
