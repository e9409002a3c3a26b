"""Toxicity: a sparse linear classifier with counterfactual regularisation.

A text is the set of its words; each word adds the weights of its own bucket and of its character n-grams' buckets, so
inflected forms of an insult are known by their stem. Weights are fitted by stochastic gradient descent on the logistic
loss with an L1 pull to zero, so common words add nothing, however long the text is.

Counterfactual regularisation: in each labelled text that mentions a group (``IDENTITY``), every mention is swapped for
each other term of its set, and the squared change of the score is penalised. A term's weight can then not stand for the
label of the texts that it happens to occur in; what remains is equal for all terms of a set. The absent mention belongs
to each set, too, so a neutral mention of a group changes a score by nothing.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardmill.llm.subwords import distinct_words, gathered, labelled_sample, lists, logistic, subword_features
from wardmill.llm.words import scan

BITS = 18
SIZES = (4, 5, 6)
PER_LABEL = 1500
EPOCHS = 12
BATCH = 64
RATE = 0.1
L1 = 3.5e-3
#: Part of the way from the sample's odds of label 1 to all labelled rows'; the pull to zero already draws scores to the middle.
PRIOR_SHIFT = 0.5
SWAP_WEIGHT = 1.0
SEED = 11

#: Neutral words for groups of people, by kind, in English, French, German and Spanish.
IDENTITY: tuple[tuple[str, ...], ...] = (
    ("woman", "man", "women", "men", "girl", "boy", "female", "male", "transgender", "nonbinary", "femme", "homme", "frau", "mann", "mujer", "hombre"),
    ("muslim", "christian", "jew", "jewish", "hindu", "buddhist", "atheist", "catholic", "musulman", "chrétien", "juif", "christ", "jude", "musulmán", "cristiano", "judío"),
    ("black", "white", "asian", "african", "european", "latino", "arab", "indian", "noir", "blanc", "schwarz", "weiß", "negro", "blanco"),
    ("gay", "lesbian", "straight", "bisexual", "queer", "homosexual", "heterosexual"),
    ("old", "young", "disabled", "blind", "deaf", "immigrant", "refugee"),
)


@dataclass
class Toxicity:
    """Bucket weights and intercept; ``score`` is a probability."""

    weights: np.ndarray
    intercept: float
    bits: int = BITS
    sizes: tuple[int, ...] = SIZES

    def logits(self, texts: pa.Array) -> np.ndarray:
        out = [np.zeros(0)]
        for piece in scan(texts):
            at, hashes, number = distinct_words(piece, piece.hashes())
            buckets, owner = subword_features(piece, at, hashes, self.sizes, self.bits)
            of_word = np.bincount(owner, weights=self.weights[buckets], minlength=len(at))
            pairs = np.unique(piece.row_of_word() * len(at) + number) if len(at) else np.zeros(0, dtype=np.int64)
            rows, words = (pairs // len(at), pairs % len(at)) if len(at) else (pairs, pairs)
            out.append(self.intercept + np.bincount(rows, weights=of_word[words], minlength=len(piece.first) - 1))
        return np.concatenate(out)

    def scores(self, texts: pa.Array) -> np.ndarray:
        return logistic(self.logits(texts))


def _features(text: str, identity: Sequence[Sequence[str]], sizes: tuple[int, ...], bits: int):
    """Rows of a labelled sample as buckets (one for each word and feature) and numbers of the identity terms in it."""
    terms = [t for group in identity for t in group]

    def run(batches):
        known = next(iter(scan(pa.array([" ".join(terms)])))).hashes() if terms else np.zeros(0, dtype=np.uint64)
        order = np.argsort(known)
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(text))
            labels = batch.column(batch.schema.get_field_index("label"))
            for piece in scan(column):
                n = len(piece.first) - 1
                hashes = piece.hashes()
                at, unique, number = distinct_words(piece, hashes)
                row = piece.row_of_word()
                buckets, owner = subword_features(piece, at, unique, sizes, bits)
                by_word = np.argsort(owner, kind="stable")
                buckets, bound = buckets[by_word], np.searchsorted(owner[by_word], np.arange(len(at) + 1))
                pairs = np.unique(np.stack([row, number]), axis=1) if len(row) else np.zeros((2, 0), dtype=np.int64)
                lengths = (bound[1:] - bound[:-1])[pairs[1]]
                place = np.repeat(bound[:-1][pairs[1]], lengths) + np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
                mentions = np.zeros((2, 0), dtype=np.int64)
                if len(known) and len(unique):
                    found = np.minimum(np.searchsorted(known, unique, sorter=order), len(known) - 1)
                    term = np.where(known[order][found] == unique, order[found], -1)[pairs[1]]
                    mentions = np.stack([pairs[0][term >= 0], term[term >= 0]])
                yield pa.RecordBatch.from_arrays([
                    labels.slice(piece.rows.start, n), lists(buckets[place].astype(np.int32), np.repeat(pairs[0], lengths), n, pa.int32()),
                    lists(mentions[1].astype(np.int32), mentions[0], n, pa.int32()),
                ], names=["label", "buckets", "mentions"])

    return run


def _term_features(terms: list[str], sizes: tuple[int, ...], bits: int) -> list[np.ndarray]:
    out = []
    for term in terms:
        piece = next(iter(scan(pa.array([term]))))
        out.append(subword_features(piece, np.arange(len(piece.start)), piece.hashes(), sizes, bits)[0])
    return out


def fit(labels: np.ndarray, buckets: np.ndarray, bounds: np.ndarray, mentions: list[np.ndarray], identity: Sequence[Sequence[str]] = IDENTITY, *,
        share: float = 0.5, bits: int = BITS, sizes: tuple[int, ...] = SIZES, epochs: int = EPOCHS, rate: float = RATE, l1: float = L1,
        swap_weight: float = SWAP_WEIGHT, seed: int = SEED) -> Toxicity:
    """``share``: part of label 1 among all labelled rows; the intercept is moved towards it from the sample's part."""
    model = Toxicity(np.zeros(1 << bits), 0.0, bits, sizes)
    positive = int(labels.sum())
    if not positive or positive == len(labels):
        model.intercept = float(np.log((positive + 0.5) / (len(labels) - positive + 0.5))) if len(labels) else -10.0
        return model
    terms, group = [t for g in identity for t in g], [i for i, g in enumerate(identity) for _ in g]
    of_term = _term_features(terms, sizes, bits)
    rng = np.random.default_rng(seed)
    w, b, seen, seen_b = model.weights, 0.0, np.full(1 << bits, 1e-4), 1e-4
    lengths = np.diff(bounds)
    for _ in range(epochs):
        for batch in np.array_split(rng.permutation(len(labels)), max(1, -(-len(labels) // BATCH))):
            own = np.concatenate([buckets[bounds[i]:bounds[i + 1]] for i in batch])
            row = np.repeat(np.arange(len(batch)), lengths[batch])
            error = logistic(np.bincount(row, weights=w[own], minlength=len(batch)) + b) - labels[batch]
            slope = np.bincount(own, weights=error[row] / len(batch), minlength=len(w))
            for i in batch:                    # the change that a swap makes: the new term's features less the old one's
                for term in mentions[i]:
                    others = [t for t in range(len(terms)) if group[t] == group[term] and t != term]
                    for other in (*others, None):       # the other terms of a set together weigh as much as three
                        new = of_term[other] if other is not None else of_term[term][:0]
                        change = w[new].sum() - w[of_term[term]].sum()
                        pull = 2 * swap_weight * change / len(batch) * (min(3, len(others)) / len(others) if other is not None else 1)
                        np.add.at(slope, new, pull)
                        np.add.at(slope, of_term[term], -pull)
            seen += slope * slope
            step = rate / np.sqrt(seen)
            w -= step * slope
            touched = slope != 0
            w[touched] = np.sign(w[touched]) * np.maximum(np.abs(w[touched]) - step[touched] * l1, 0)
            seen_b += error.mean() ** 2
            b -= rate / np.sqrt(seen_b) * error.mean()
    part = positive / len(labels)
    shift = np.log(share / (1 - share)) - np.log(part / (1 - part)) if 0 < share < 1 else 0.0
    model.intercept = float(b + PRIOR_SHIFT * shift)
    return model


def train(docs: DataFrame, labels: DataFrame, *, id_: str = "doc_id", text: str = "text", label: str = "toxic", use: Column | None = None,
          per_label: int = PER_LABEL, identity: Sequence[Sequence[str]] = IDENTITY, bits: int = BITS, sizes: tuple[int, ...] = SIZES, **settings) -> Toxicity:
    """Fits on at most ``per_label`` labelled rows of each label; ``use`` picks the rows of ``labels`` that may be learned from.

    With no labelled row every score is near 0; with one label only, all scores are that label's smoothed share.
    """
    sample = labelled_sample(labels, id_, label, per_label, use)
    counts = dict((labels if use is None else labels.where(use)).where(F.col(label).isin(0, 1)).groupBy(label).count().collect())
    texts = docs.select(F.col(id_).cast("long").alias("id"), F.col(text).alias("text")).join(F.broadcast(sample), "id").select("text", "label")
    rows = texts.mapInArrow(_features("text", identity, sizes, bits), "label int, buckets array<int>, mentions array<int>").toArrow()
    buckets, bounds = gathered(rows.column("buckets"))
    mentions = [np.array(x, dtype=np.int64) for x in rows.column("mentions").to_pylist()]
    marks = rows.column("label").to_numpy().astype(np.int64)
    del rows
    total = sum(counts.values())
    return fit(marks, buckets, bounds, mentions, identity,
               share=counts.get(1, 0) / total if total else 0.0, bits=bits, sizes=sizes, **settings)


def with_scores(docs: DataFrame, model, *, text: str = "text", name: str = "score") -> DataFrame:
    """All columns and a double ``name``; a null or empty text is scored like one without words. An older ``name`` is replaced."""
    docs = docs.drop(name)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())])

    def run(batches):
        for batch in batches:
            scores = shared.value.scores(batch.column(batch.schema.get_field_index(text)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores)], names=[*batch.schema.names, name])

    return docs.mapInArrow(run, schema)
