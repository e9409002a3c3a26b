"""Quality: supervised subword embeddings.

Each visible token, each pair of neighbours and each character n-gram of a token has a hashed bucket with a learned
vector. A document is the mean of its vectors, and a softmax layer over that mean gives the classes' probabilities. Both
are trained by stochastic gradient descent in numpy on a bounded sample of labelled rows. A token that repeats its
predecessor makes one pair feature of its own, whatever the token: runs of one word are then a learnable sign.

As mean and output layer are linear, a bucket's vector adds one number per class to a document's logits; scoring looks
up these products instead of the vectors, which is the same sum.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardmill.llm.subwords import bucket, distinct_words, gathered, labelled_sample, lists, subword_features
from wardmill.llm.words import VISIBLE_BYTES, Words, mix, scan

BITS = 17
SIZES = (2, 3, 4)
DIMENSIONS = 8
PER_LABEL = 1500
EPOCHS = 12
BATCH = 64
RATE = 0.5
SEED = 5
_SAME = mix(np.array([1], dtype=np.uint64))[0]


def _pairs(hashes: np.ndarray, row: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of neighbouring tokens, and their rows."""
    within = row[1:] == row[:-1]
    left, right = hashes[:-1][within], hashes[1:][within]
    pair = np.where(left == right, _SAME, mix(left * np.uint64(3) + right))
    return bucket(pair, bits), row[1:][within]


@dataclass
class Quality:
    """``vectors`` (a row for each bucket), ``output`` (vector to logits) and ``bias`` of the two classes."""

    vectors: np.ndarray
    output: np.ndarray
    bias: np.ndarray
    bits: int = BITS
    sizes: tuple[int, ...] = SIZES

    def scores(self, texts: pa.Array) -> np.ndarray:
        """Probability of class 1."""
        value = (self.vectors @ self.output).astype(np.float64)
        value = value[:, 1] - value[:, 0]
        out = [np.zeros(0)]
        for piece in scan(texts, VISIBLE_BYTES, lower=False):
            n = len(piece.first) - 1
            hashes, row = piece.hashes(), piece.row_of_word()
            at, unique, number = distinct_words(piece, hashes)
            features, owner = subword_features(piece, at, unique, self.sizes, self.bits)
            sums = np.bincount(owner, weights=value[features], minlength=len(at))
            sizes = np.bincount(owner, minlength=len(at))
            pair, pair_row = _pairs(hashes, row, self.bits)
            total = np.bincount(row, weights=sums[number], minlength=n) + np.bincount(pair_row, weights=value[pair], minlength=n)
            count = np.bincount(row, weights=sizes[number], minlength=n) + np.bincount(pair_row, minlength=n)
            logit = total / np.maximum(count, 1) + self.bias[1] - self.bias[0]
            out.append(1 / (1 + np.exp(-np.clip(logit, -500, 500))))
        return np.concatenate(out)


def _row_features(piece: Words, sizes: tuple[int, ...], bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of each row with their share of the row's features, sorted by row: buckets, shares, rows."""
    n = len(piece.first) - 1
    hashes, row = piece.hashes(), piece.row_of_word()
    at, unique, number = distinct_words(piece, hashes)
    features, owner = subword_features(piece, at, unique, sizes, bits)
    order = np.argsort(owner, kind="stable")
    features, bound = features[order], np.searchsorted(owner[order], np.arange(len(at) + 1))
    lengths = (bound[1:] - bound[:-1])[number]
    place = np.repeat(bound[:-1][number], lengths) + np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    pair, pair_row = _pairs(hashes, row, bits)
    key = np.concatenate([np.repeat(row, lengths), pair_row]) << bits | np.concatenate([features[place], pair])
    keys, times = np.unique(key, return_counts=True)
    rows = keys >> bits
    return keys & ((1 << bits) - 1), times / np.bincount(rows, weights=times, minlength=n)[rows], rows


def _features(sizes: tuple[int, ...], bits: int):
    def run(batches):
        for batch in batches:
            labels = batch.column(batch.schema.get_field_index("label"))
            for piece in scan(batch.column(batch.schema.get_field_index("text")), VISIBLE_BYTES, lower=False):
                n = len(piece.first) - 1
                buckets, shares, rows = _row_features(piece, sizes, bits)
                yield pa.RecordBatch.from_arrays([labels.slice(piece.rows.start, n), lists(buckets.astype(np.int32), rows, n, pa.int32()),
                                                  lists(shares.astype(np.float32), rows, n, pa.float32())], names=["label", "buckets", "shares"])

    return run


def fit(labels: np.ndarray, buckets: np.ndarray, shares: np.ndarray, bounds: np.ndarray, *, share: float = 0.5, bits: int = BITS,
        sizes: tuple[int, ...] = SIZES, dimensions: int = DIMENSIONS, epochs: int = EPOCHS, rate: float = RATE, seed: int = SEED) -> Quality:
    """``share``: part of label 1 among all labelled rows; the bias is moved from the sample's part to that one."""
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / dimensions, 1 / dimensions, (1 << bits, dimensions))
    model = Quality(vectors, np.zeros((dimensions, 2)), np.zeros(2), bits, sizes)
    positive = int(labels.sum())
    if not positive or positive == len(labels):
        model.bias = np.array([0.0, float(np.log((positive + 0.5) / (len(labels) - positive + 0.5))) if len(labels) else 10.0])
        return model
    grown = [np.full(x.shape, 1e-6) for x in (model.vectors, model.output, model.bias)]
    lengths = np.diff(bounds)
    for _ in range(epochs):
        for batch in np.array_split(rng.permutation(len(labels)), max(1, -(-len(labels) // BATCH))):
            place = np.concatenate([np.arange(bounds[i], bounds[i + 1]) for i in batch])
            own, weight, row = buckets[place], shares[place], np.repeat(np.arange(len(batch)), lengths[batch])
            unique, number = np.unique(own, return_inverse=True)
            rows = model.vectors[unique]
            mean = np.stack([np.bincount(row, weights=weight * rows[number, d], minlength=len(batch)) for d in range(rows.shape[1])], axis=1)
            logits = mean @ model.output + model.bias
            odds = np.exp(logits - logits.max(axis=1, keepdims=True))
            error = odds / odds.sum(axis=1, keepdims=True)
            error[np.arange(len(batch)), labels[batch]] -= 1
            error /= len(batch)
            back = error @ model.output.T
            slopes = np.stack([np.bincount(number, weights=weight * back[row, d], minlength=len(unique)) for d in range(rows.shape[1])], axis=1)
            grown[0][unique] += slopes * slopes
            model.vectors[unique] -= rate * slopes / np.sqrt(grown[0][unique])
            for i, (values, slope) in enumerate(((model.output, mean.T @ error), (model.bias, error.sum(axis=0))), start=1):
                grown[i] += slope * slope
                values -= rate * slope / np.sqrt(grown[i])
    if 0 < share < 1:
        model.bias = model.bias + np.array([np.log(1 - share) - np.log(1 - positive / len(labels)), np.log(share) - np.log(positive / len(labels))])
    return model


def train(docs: DataFrame, labels: DataFrame, *, id_: str = "doc_id", text: str = "text", label: str = "quality", use: Column | None = None,
          per_label: int = PER_LABEL, bits: int = BITS, sizes: tuple[int, ...] = SIZES, **settings) -> Quality:
    """Fits on at most ``per_label`` labelled rows of each label; ``use`` picks the rows of ``labels`` that may be learned from.

    With no labelled row every score is near 1; with one label only, all scores are that label's smoothed share.
    """
    sample = labelled_sample(labels, id_, label, per_label, use)
    counts = dict((labels if use is None else labels.where(use)).where(F.col(label).isin(0, 1)).groupBy(label).count().collect())
    texts = docs.select(F.col(id_).cast("long").alias("id"), F.col(text).alias("text")).join(F.broadcast(sample), "id").select("text", "label")
    rows = texts.mapInArrow(_features(sizes, bits), "label int, buckets array<int>, shares array<float>").toArrow()
    buckets, bounds = gathered(rows.column("buckets"))
    shares, _ = gathered(rows.column("shares"))
    marks = rows.column("label").to_numpy().astype(np.int64)
    del rows
    total = sum(counts.values())
    return fit(marks, buckets, shares, bounds,
               share=counts.get(1, 0) / total if total else 0.0, bits=bits, sizes=sizes, **settings)
