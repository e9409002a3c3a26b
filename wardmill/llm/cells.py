"""Groups of rows for pairwise work, with large groups cut into cells of bounded size.

A group of n rows over ``limit`` is cut into g = ceil(n / limit) blocks by a hash of the row's id, and a cell holds two
blocks, so every pair of the group meets in a cell, no task holds more than two blocks, and rows are only copied in such
groups, g times. Groups of one row are dropped.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def cells(rows: DataFrame, key: str, id_: str | list[str], limit: int, payload: DataFrame | None = None) -> DataFrame:
    """Rows with ``cell`` (of ``key`` and two blocks) and ``block`` (0 or 1: the row's side; all 0 in a cell of one block).

    Ids (a column or several) are unique in a group. ``payload`` has a row per id, which joins only rows that are in a group of several, so that
    wide columns do not travel with the others. Rows of a cell lie together, sorted by cell and id.
    """
    ids = [id_] if isinstance(id_, str) else id_
    sizes = rows.groupBy(key).agg(F.count(F.lit(1)).alias("__n")).where("__n > 1")
    g = F.ceil(F.col("__n") / limit).cast("int")
    own = F.pmod(F.xxhash64(*ids), F.col("__g"))
    kept = rows.join(sizes, key)
    if payload is not None:
        kept = kept.join(payload, ids)
    return (
        kept.withColumn("__g", g).withColumn("__own", own.cast("int"))
        .withColumn("__other", F.explode(F.sequence(F.lit(0), F.col("__g") - 1)))
        .withColumn("cell", F.xxhash64(key, F.least("__own", "__other"), F.greatest("__own", "__other")))
        .withColumn("block", (F.col("__own") > F.col("__other")).cast("int"))
        .withColumn("alone", F.col("__own") == F.col("__other"))
        .drop("__n", "__g", "__own", "__other")
        .repartition("cell").sortWithinPartitions("cell", key, *ids)
    )


def complete_groups(batches: Iterator[pa.RecordBatch], key: str = "cell") -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole groups of a partition sorted by ``key``, with the bounds of the groups in them."""
    kept: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        kept.append(batch)
        column = batch.column(batch.schema.get_field_index(key))
        if column[0] == column[-1] and (len(kept) == 1 or kept[-2].column(kept[-2].schema.get_field_index(key))[-1] == column[0]):
            continue                                   # one group so far
        table = pa.Table.from_batches(kept)
        keys = table.column(key).to_numpy()
        last = int(np.searchsorted(keys, keys[-1]))
        if last:
            yield table.slice(0, last), _bounds(keys[:last])
        kept = table.slice(last).combine_chunks().to_batches()
    if kept:
        table = pa.Table.from_batches(kept)
        yield table, _bounds(table.column(key).to_numpy())


def _bounds(keys: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]])


class Classes:
    """Union by smallest member of 0..n-1, with vectorised look-up of all roots."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def join(self, i: int, j: int) -> None:
        a, b = sorted((self.root[i], self.root[j]))
        self.root[self.root == b] = a


def linked_pairs(scores: np.ndarray, least: float, allowed: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Pairs i < j with a score of at least ``least``, best first."""
    good = np.triu(scores >= least, 1)
    if allowed is not None:
        good &= allowed
    i, j = np.nonzero(good)
    order = np.argsort(-scores[i, j], kind="stable")
    return i[order], j[order]


def spanning_links(i: np.ndarray, j: np.ndarray, n: int, test: Callable[[int, int], bool] | None = None, step: int = 4096) -> list[tuple[int, int]]:
    """Links of a spanning forest of the pairs that pass the test. Pairs already connected need no test."""
    classes, found = Classes(n), []
    for at in range(0, len(i), step):
        a, b = i[at:at + step], j[at:at + step]
        open_ = classes.root[a] != classes.root[b]
        for x, y in zip(a[open_].tolist(), b[open_].tolist(), strict=True):
            if classes.root[x] != classes.root[y] and (test is None or test(x, y)):
                classes.join(x, y)
                found.append((x, y))
    return found
