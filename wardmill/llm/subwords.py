"""Hashed words and character n-grams, and bounded samples of labelled texts."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardmill.llm.words import Words, mix

_BASE = np.uint64(0x100000001B3)


def bucket(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (mix(hashes) >> np.uint64(64 - bits)).astype(np.int64)


def distinct_words(piece: Words, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First place of each distinct word of a piece, its hash, and for each word the number of its distinct one."""
    unique, at, number = np.unique(hashes, return_index=True, return_inverse=True)
    return at, unique, number


def subword_features(piece: Words, at: np.ndarray, hashes: np.ndarray, sizes: tuple[int, ...], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the given words and of their byte n-grams (word ends marked), and the number of the word of each."""
    start, length = piece.start[at], piece.end[at] - piece.start[at]
    first = np.concatenate([[0], np.cumsum(length + 2)])
    padded = np.full(first[-1], 0x20, dtype=np.uint64)      # the mark is no byte of a word
    word = np.repeat(np.arange(len(at)), length)
    inside = np.arange(len(word)) - np.repeat(np.cumsum(length) - length, length)
    padded[first[:-1][word] + 1 + inside] = piece.data[start[word] + inside]
    owner = np.repeat(np.arange(len(at)), length + 2)
    room = first[1:][owner] - np.arange(len(padded))
    buckets, owners = [bucket(hashes, bits)], [np.arange(len(at))]
    for size in sizes:
        n = len(padded) - size + 1
        if n <= 0:
            continue
        total = np.full(n, size, dtype=np.uint64)
        for j in range(size):
            total = total * _BASE + padded[j:j + n] + np.uint64(1)
        fits = room[:n] >= size
        buckets.append(bucket(total[fits], bits))
        owners.append(owner[:n][fits])
    return np.concatenate(buckets), np.concatenate(owners)


def labelled_sample(labels: DataFrame, id_: str, label: str, per_label: int, use: Column | None = None) -> DataFrame:
    """``id`` and ``label`` (0 or 1) of at most ``per_label`` rows of each label, drawn by a hash of the id.

    Rows without an id or a label are left out; repeated ids count once.
    """
    rows = labels if use is None else labels.where(use)
    rows = rows.select(F.col(id_).cast("long").alias("id"), F.col(label).cast("int").alias("label")).where("id is not null and label in (0, 1)")
    parts = [rows.where(F.col("label") == v).distinct().orderBy(F.xxhash64("id"), "id").limit(per_label) for v in (0, 1)]
    return parts[0].union(parts[1])


def lists(values: np.ndarray, rows: np.ndarray, n: int, kind: pa.DataType) -> pa.Array:
    """List column of n rows from values sorted by row."""
    offsets = np.searchsorted(rows, np.arange(n + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values).cast(kind))


def gathered(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Values and row offsets of a collected list column."""
    arrays = [c for c in column.chunks if len(c)]
    lengths = np.concatenate([c.value_lengths().to_numpy(zero_copy_only=False) for c in arrays]) if arrays else np.zeros(0, np.int64)
    values = np.concatenate([c.flatten().to_numpy(zero_copy_only=False) for c in arrays]) if arrays else np.zeros(0, np.int32)
    return values, np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)


def logistic(x):
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))
