"""Language identification: averaged hashed subword embeddings and a linear softmax.

Each distinct word of a text and each of its byte n-grams (word ends marked) has a hashed bucket with a learned vector. A text
is the mean of the vectors of all its words, repeats counted; a linear layer over that mean and a softmax give the languages'
probabilities, under equal shares of the languages. Vectors and layer are trained by stochastic gradient descent in numpy.

One in five rows of the labelled sample is kept out of training and calibrates the result: a temperature that makes the
probabilities honest, and two limits below which an answer is rejected. A prediction is rejected if its probability, or the share
of the text's features that training has ever seen, is lower than in all but ``MISS`` of the kept-out rows that were
predicted rightly. A text in a foreign script has no known feature, and one in a foreign language of the same script few.

The sample: at most ``PER_LANGUAGE`` different texts of a language and ``SAMPLE_ROWS`` in all, drawn by a hash of the id, and
at most ``SAMPLE_BYTES`` of text, shared equally by the languages (the first text of a language is in whatever its length).
Of more than ``SAMPLE_ROWS`` languages, the most frequent are learned. Every text is scored, and scored whole.

Defined results: a text that is null or has no letter is ``und`` with score 0, as is every text when nothing could be learned;
with one language only, all others are that one with score 1. Rows without id, text or language are not learned from; repeated
rows count once in the sample and each has its result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardmill.llm.subwords import distinct_words, gathered, lists, subword_features
from wardmill.llm.words import scan

UNKNOWN = "und"
BITS = 17
SIZES = (2, 3, 4)
DIMENSIONS = 8
PER_LANGUAGE = 400
SAMPLE_ROWS = 6000
SAMPLE_BYTES = 16 << 20
EPOCHS = 6
BATCH = 32
RATE = 0.5
SEED = 7
#: One in so many sampled rows calibrates.
KEPT_OUT = 5
#: Share of right predictions that the limits reject.
MISS = 0.01
#: Longer texts are cut at a blank and their pieces' sums added.
LONG_BYTES = 1 << 22


def _pieces(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The texts with long ones in pieces, and the row of each piece."""
    lengths = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    if not len(column) or int(lengths.max()) <= LONG_BYTES:
        return column, np.arange(len(column))
    texts, owner = [], []
    for i, size in enumerate(lengths.tolist()):
        data, at = (column[i].as_buffer().to_pybytes() if size else b""), 0
        while size - at > LONG_BYTES:
            stop = data.rfind(b" ", at + 1, at + LONG_BYTES)
            if stop < 0:
                stop = at + LONG_BYTES
                while data[stop] & 0xC0 == 0x80:           # no blank: at least not inside a character
                    stop -= 1
            texts.append(data[at:stop])
            owner.append(i)
            at = stop
        texts.append(data[at:])
        owner.append(i)
    return pa.array(texts, pa.binary()).cast(pa.string()), np.array(owner)


@dataclass
class Languages:
    """``vectors``: a row for each bucket; ``seen``: buckets that training met; ``output`` and ``bias``: vector to logits."""

    names: list[str]
    vectors: np.ndarray
    seen: np.ndarray
    output: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    least_score: float = 0.0
    least_seen: float = 0.0
    bits: int = BITS
    sizes: tuple[int, ...] = SIZES

    def means(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Logits of the texts and the shares of their features that training has seen."""
        short = len(self.names) <= self.vectors.shape[1]
        values = self.vectors @ self.output if short else self.vectors      # the mean and the layer are linear
        values = np.concatenate([values, self.seen[:, None], np.ones((len(values), 1))], axis=1)
        pieces, owner = _pieces(texts)
        total = np.zeros((len(texts), values.shape[1]))
        for piece in scan(pieces):
            if not len(piece.start):
                continue
            rows, row = owner[piece.rows], piece.row_of_word()
            at, unique, number = distinct_words(piece, piece.hashes())
            features, word = subword_features(piece, at, unique, self.sizes, self.bits)
            own = values[features]
            for c in range(values.shape[1]):
                of_word = np.bincount(word, weights=own[:, c], minlength=len(at))
                np.add.at(total[:, c], rows, np.bincount(row, weights=of_word[number], minlength=len(rows)))
        mean = total / np.maximum(total[:, -1:], 1)
        return (mean[:, :-2] if short else mean[:, :-2] @ self.output) + self.bias, mean[:, -2]

    def predictions(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Number of the best language, its probability, and whether the answer is rejected."""
        logits, seen = self.means(texts)
        odds = np.exp((logits - logits.max(axis=1, keepdims=True)) / self.temperature)
        best = logits.argmax(axis=1)
        score = 1 / odds.sum(axis=1)
        return best, score, (score < self.least_score) | (seen < self.least_seen)


def _row_features(sizes: tuple[int, ...], bits: int):
    """Arrow function: language number and features of each text, with their shares."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, kept = batch.column(0), batch.column(2)
            for piece in scan(batch.column(1)):
                n, row = len(piece.first) - 1, piece.row_of_word()
                at, unique, number = distinct_words(piece, piece.hashes())
                features, word = subword_features(piece, at, unique, sizes, bits)
                by_word = np.argsort(word, kind="stable")
                features, bound = features[by_word], np.searchsorted(word[by_word], np.arange(len(at) + 1))
                pairs, times = np.unique(row * max(len(at), 1) + number, return_counts=True)
                rows, words = pairs // max(len(at), 1), pairs % max(len(at), 1)
                lengths = (bound[1:] - bound[:-1])[words]
                place = np.repeat(bound[:-1][words], lengths) + np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
                keys, which = np.unique(np.repeat(rows, lengths) << bits | features[place], return_inverse=True)
                counts = np.bincount(which, weights=np.repeat(times, lengths), minlength=len(keys))
                rows = keys >> bits
                shares = counts / np.bincount(rows, weights=counts, minlength=n)[rows]
                yield pa.RecordBatch.from_arrays([
                    names.slice(piece.rows.start, n), kept.slice(piece.rows.start, n),
                    lists((keys & ((1 << bits) - 1)).astype(np.int32), rows, n, pa.int32()), lists(shares.astype(np.float32), rows, n, pa.float32()),
                ], names=["name", "kept", "buckets", "shares"])

    return run


def _averages(values: np.ndarray, buckets: np.ndarray, shares: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Weighted means of rows that all have features."""
    return np.add.reduceat(values[buckets] * shares[:, None], bounds[:-1], axis=0)


def _picked(rows: np.ndarray, buckets: np.ndarray, shares: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    lengths = (bounds[1:] - bounds[:-1])[rows]
    ends = np.cumsum(lengths)
    place = np.repeat(bounds[rows] - (ends - lengths), lengths) + np.arange(lengths.sum())
    return buckets[place], shares[place], np.concatenate([[0], ends])


def fit(names: list[str], labels: np.ndarray, kept: np.ndarray, buckets: np.ndarray, shares: np.ndarray, bounds: np.ndarray, *, bits: int = BITS,
        sizes: tuple[int, ...] = SIZES, dimensions: int = DIMENSIONS, epochs: int = EPOCHS, rate: float = RATE, miss: float = MISS, seed: int = SEED) -> Languages:
    """``labels``: numbers of ``names``; ``kept``: rows that calibrate."""
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / dimensions, 1 / dimensions, (1 << bits, dimensions))
    output, bias = np.zeros((dimensions, len(names))), np.zeros(len(names))
    grown = [np.full(x.shape, 1e-6) for x in (vectors, output, bias)]
    full = bounds[1:] > bounds[:-1]
    learned = np.flatnonzero(~kept & full)
    for _ in range(epochs):
        for batch in np.array_split(rng.permutation(learned), max(1, -(-len(learned) // BATCH))):
            if not len(batch):
                continue
            own, weight, starts = _picked(batch, buckets, shares, bounds)
            mean = _averages(vectors, own, weight, starts)
            logits = mean @ output + bias
            odds = np.exp(logits - logits.max(axis=1, keepdims=True))
            error = odds / odds.sum(axis=1, keepdims=True)
            error[np.arange(len(batch)), labels[batch]] -= 1
            error /= len(batch)
            back = np.repeat(error @ output.T, np.diff(starts), axis=0) * weight[:, None]
            unique, number = np.unique(own, return_inverse=True)
            slopes = np.stack([np.bincount(number, weights=back[:, d], minlength=len(unique)) for d in range(dimensions)], axis=1)
            grown[0][unique] += slopes * slopes
            vectors[unique] -= rate * slopes / np.sqrt(grown[0][unique])
            for i, (values, slope) in enumerate(((output, mean.T @ error), (bias, error.sum(axis=0))), start=1):
                grown[i] += slope * slope
                values -= rate * slope / np.sqrt(grown[i])
    seen = np.zeros(1 << bits)
    if len(learned):
        seen[_picked(learned, buckets, shares, bounds)[0]] = 1
    model = Languages(names, vectors, seen, output, bias, bits=bits, sizes=sizes)
    checked = np.flatnonzero(kept & full)
    if len(checked):
        own, weight, starts = _picked(checked, buckets, shares, bounds)
        logits = _averages(vectors, own, weight, starts) @ output + bias
        model.temperature = _temperature(logits, labels[checked])
        odds = np.exp((logits - logits.max(axis=1, keepdims=True)) / model.temperature)
        right = logits.argmax(axis=1) == labels[checked]
        if right.any():
            model.least_score = float(np.quantile(1 / odds.sum(axis=1)[right], miss, method="lower"))
            model.least_seen = float(np.quantile(_averages(seen[:, None], own, weight, starts)[right, 0], miss, method="lower"))
    return model


def _temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """Least log loss on the rows that were kept out, among temperatures from 1/32 to 32; a virtual mistake keeps it off zero."""
    right = logits[np.arange(len(labels)), labels]

    def loss(t: float) -> float:
        scaled = logits / t
        top = scaled.max(axis=1)
        total = top + np.log(np.exp(scaled - top[:, None]).sum(axis=1))
        return float((total - right / t).sum() + (total - scaled.min(axis=1)).mean())

    choices = np.exp2(np.linspace(-5, 5, 161))
    return float(choices[int(np.argmin([loss(t) for t in choices]))])


def sample(docs: DataFrame, *, id_: str, text: str, lang: str, use: Column | None, per_language: int, rows: int, text_bytes: int) -> DataFrame:
    """``name``, ``text`` and ``kept``: the bounded sample of labelled rows, with no text of a language twice."""
    own = docs.select(F.col(lang).cast("string").alias("name"), F.col(text).alias("text"), F.xxhash64(F.col(id_).cast("string"), F.lit(SEED)).alias("draw"),
                      (F.lit(True) if use is None else use).alias("use"), F.col(id_).isNotNull().alias("known")).where("use and known and name is not null and text is not null")
    sizes = own.groupBy("name").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "name").limit(rows)
    total = max(1, sizes.count())
    each = max(1, min(per_language, rows // total))
    shares = sizes.select("name", (F.lit(4.0 * each + 20) / F.col("n")).alias("share"))      # more than are needed, as texts repeat
    drawn = own.join(F.broadcast(shares), "name").where(F.pmod("draw", F.lit(1 << 40)) < F.col("share") * float(1 << 40))
    different = drawn.dropDuplicates(["name", "text"]) if each == 1 else drawn.groupBy("name", "text").agg(F.min("draw").alias("draw"))
    by_draw = Window.partitionBy("name").orderBy("draw", "text")
    few = different.withColumn("rank", F.row_number().over(by_draw)).where(F.col("rank") <= each)
    before = F.sum(F.octet_length("text").cast("long")).over(by_draw.rowsBetween(Window.unboundedPreceding, 0))
    few = few.withColumn("bytes", before).where((F.col("bytes") <= text_bytes // total) | (F.col("rank") == 1))
    return few.select("name", "text", (F.col("rank") % KEPT_OUT == 0).alias("kept"))


def train(docs: DataFrame, *, id_: str = "doc_id", text: str = "text", lang: str = "lang", use: Column | None = None, per_language: int = PER_LANGUAGE,
          rows: int = SAMPLE_ROWS, text_bytes: int = SAMPLE_BYTES, bits: int = BITS, sizes: tuple[int, ...] = SIZES, **settings) -> Languages | None:
    """Fits on the sample of the rows that ``use`` allows; None if there is none."""
    few = sample(docs, id_=id_, text=text, lang=lang, use=use, per_language=per_language, rows=rows, text_bytes=text_bytes)
    found = few.mapInArrow(_row_features(sizes, bits), "name string, kept boolean, buckets array<int>, shares array<float>").toArrow()
    if not found.num_rows:
        return None
    found = found.take(pc.sort_indices(found.column("name")))
    buckets, bounds = gathered(found.column("buckets"))
    shares, _ = gathered(found.column("shares"))
    names, labels = np.unique(np.array(found.column("name").to_pylist(), dtype=object), return_inverse=True)
    kept = found.column("kept").to_numpy()
    del found
    return fit([str(x) for x in names], labels, kept, buckets, shares.astype(np.float64), bounds, bits=bits, sizes=sizes, **settings)


def with_language(docs: DataFrame, model: Languages | None, *, text: str = "text", name: str = "lang_pred", score: str = "score", rejected: str = "rejected") -> DataFrame:
    """All columns and the predicted language, its probability, and whether calibration rejects it; older columns of these names are replaced."""
    docs = docs.drop(name, score, rejected)
    if model is None:
        return docs.withColumns({name: F.lit(UNKNOWN), score: F.lit(0.0), rejected: F.lit(True)})
    shared = docs.sparkSession.sparkContext.broadcast(model)
    fields = [T.StructField(name, T.StringType()), T.StructField(score, T.DoubleType()), T.StructField(rejected, T.BooleanType())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        names = np.array([*m.names, UNKNOWN], dtype=object)
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text))
            best, value, low = m.predictions(texts)
            letters = pc.fill_null(pc.match_substring_regex(texts, r"\pL"), False).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(names[np.where(letters, best, len(m.names))].tolist(), pa.string()),
                                              pa.array(np.where(letters, value, 0.0)), pa.array(low | ~letters)], names=[*batch.schema.names, name, score, rejected])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *fields]))
