"""Benchmark decontamination by winnowing.

Fingerprints: of every run of ``window - k + 1`` successive k-gram hashes the
rightmost smallest one is kept. Two texts that share ``window`` words share
such a run, hence a fingerprint, so no shared span of that length is missed.
Equal fingerprints are only seeds: each is extended along its diagonal by
comparing word hashes, as far as a window with the seed reaches, and only runs
of at least ``window`` words count. An item shorter than a window is one window
of its own length, with fingerprints made for that length. Fingerprints of an
item that stand in equal surroundings of that reach give equal results, so one
of them is kept: repeated words and periods cost no more than other text. Seeds
are extended ``STEP`` at a time, which bounds memory.

The documents are read once for each block of items and never shuffled. A
block of the benchmark's fingerprints is at most ``block_bytes`` of text, which
bounds what is broadcast; a larger benchmark takes more passes, each written
to the shared folder before the next.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardmill.llm.shared import stored
from wardmill.llm.words import grams, mix, scan

WINDOW = 13
GRAM = 5
BLOCK_BYTES = 32 << 20
STEP = 1 << 18

SPAN = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
HITS = T.StructType([
    T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()),
    T.StructField("spans", T.ArrayType(SPAN)), T.StructField("items", T.ArrayType(T.LongType())),
])
_SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64())])
_HITS = pa.struct([("n_words", pa.int64()), ("n_hit", pa.int64()), ("spans", pa.list_(_SPAN)), ("items", pa.list_(pa.int64()))])


def winnow(hashes: np.ndarray, k: int, window: int, fits: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Positions and k-gram hashes kept from a word sequence. ``fits``: where a window of words may start."""
    found = grams(hashes, k)
    width = window - k + 1
    n = len(found) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    least, at = found[:n].copy(), np.arange(n)
    for j in range(1, width):
        other = found[j:j + n]
        better = other <= least
        least = np.where(better, other, least)
        at[better] = np.flatnonzero(better) + j
    if fits is not None:
        at = at[fits[:n]]
    at = np.unique(at)
    return at, found[at]


@dataclass
class Fingerprints:
    """Sorted fingerprints of a block of items, by the window length they guarantee: k, hashes, items, places in ``words``.

    ``words`` holds the word hashes of all items, item i those from ``first[i]`` to ``first[i + 1]``.
    """

    ids: list
    words: np.ndarray
    first: np.ndarray
    tables: dict[int, tuple[int, np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=dict)


def _surroundings(words: np.ndarray, at: np.ndarray, k: int, reach: int) -> np.ndarray:
    """For each place a hash of the words from ``reach`` before the gram to ``reach`` after it, the text's ends included."""
    out = np.zeros(len(at), dtype=np.uint64)
    for j in range(-reach, k + reach):
        place = at + j
        inside = (place >= 0) & (place < len(words))
        out = mix(out + np.where(inside, words[np.clip(place, 0, len(words) - 1)], np.uint64(0)) + inside.astype(np.uint64))
    return out


def fingerprints(ids: list, texts: pa.Array, window: int = WINDOW, gram: int = GRAM) -> Fingerprints:
    words: list[np.ndarray] = []
    for piece in scan(texts):
        hashes = piece.hashes()
        words += [hashes[a:b].copy() for a, b in zip(piece.first[:-1], piece.first[1:], strict=True)]
    first = np.concatenate([[0], np.cumsum([len(own) for own in words], dtype=np.int64)])
    by_length: dict[int, list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = defaultdict(list)
    for i, own in enumerate(words):
        length = min(len(own), window)
        if length:
            k = min(gram, length)
            at, found = winnow(own, k, length)
            _, one = np.unique(_surroundings(own, at, k, length - k), return_index=True)
            by_length[length].append((found[one], np.full(len(one), i), at[one] + first[i]))
    out = Fingerprints(ids, np.concatenate([*words, np.zeros(0, dtype=np.uint64)]), first)
    for length, parts in by_length.items():
        found, item, at = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.argsort(found, kind="stable")
        out.tables[length] = (min(gram, length), found[order], item[order], at[order])
    return out


def _reach(words: np.ndarray, seed: np.ndarray, end: np.ndarray, own: np.ndarray, place: np.ndarray, own_end: np.ndarray, steps: int, way: int) -> np.ndarray:
    """How many words are equal one after the other from each seed and place on, at most ``steps``; ``end``: first place outside."""
    out, same = np.zeros(len(seed), dtype=np.int64), np.ones(len(seed), dtype=bool)
    for j in range(steps):
        p, q = seed + way * j, place + way * j
        same &= (way * p < way * end) & (way * q < way * own_end)
        same[same] = words[p[same]] == own[q[same]]
        out += same
    return out


def _runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edges = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)


def find_hits(texts: pa.Array, index: Fingerprints) -> Iterator[tuple[int, list[tuple[int, int]], set[int]]]:
    """For each row: number of words, merged hit spans in words, numbers of the items that occur."""
    for piece in scan(texts):
        hashes, row = piece.hashes(), piece.row_of_word()
        left = piece.first[1:][row] - np.arange(len(hashes))
        edges = np.zeros(len(hashes) + 1, dtype=np.int64)
        items: dict[int, set[int]] = defaultdict(set)
        for length, (k, prints, owner, place) in index.tables.items():
            at, found = winnow(hashes, k, length, left >= length)
            low, high = np.searchsorted(prints, found, "left"), np.searchsorted(prints, found, "right")
            upto = np.cumsum(high - low)
            for step in range(0, int(upto[-1]) if len(upto) else 0, STEP):
                pair = np.arange(step, min(step + STEP, int(upto[-1])))
                of = np.searchsorted(upto, pair, "right")
                seed, entry = at[of], high[of] - (upto[of] - pair)
                r, item, spot = row[seed], owner[entry], place[entry]
                after = _reach(hashes, seed, piece.first[r + 1], index.words, spot, index.first[item + 1], length, 1)
                before = _reach(hashes, seed - 1, piece.first[r] - 1, index.words, spot - 1, index.first[item] - 1, length - k, -1)
                good = (after >= k) & (before + after >= length)
                np.add.at(edges, (seed - before)[good], 1)
                np.add.at(edges, (seed + after)[good], -1)
                for x, y in np.unique(np.stack([r[good], item[good]]), axis=1).T.tolist():
                    items[x].add(y)
        hit = np.cumsum(edges)[:-1] > 0
        for r in range(len(piece.first) - 1):
            a, b = piece.first[r], piece.first[r + 1]
            spans = [(int(s), int(e)) for s, e in zip(*_runs(hit[a:b]), strict=True)] if r in items else []
            yield int(b - a), spans, items.get(r, set())


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def _pass(docs: DataFrame, index, text: str, name: str) -> DataFrame:
    names = [n for n in docs.columns if n != name]
    schema = T.StructType([docs.schema[n] for n in names] + [T.StructField(name, HITS)])
    again = name in docs.columns

    def run(batches):
        own = index.value
        for batch in batches:
            before = batch.column(batch.schema.get_field_index(name)).to_pylist() if again else None
            rows = []
            for i, (n_words, spans, items) in enumerate(find_hits(batch.column(batch.schema.get_field_index(text)), own)):
                ids = {own.ids[x] for x in items} - {None}
                if again:
                    spans = _merged(spans + [(x["start"], x["end"]) for x in before[i]["spans"]])
                    ids |= set(before[i]["items"])
                rows.append({"n_words": n_words, "n_hit": sum(e - s for s, e in spans),
                             "spans": [{"start": s, "end": e} for s, e in spans], "items": sorted(ids)})
            kept = [batch.column(batch.schema.get_field_index(n)) for n in names]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(rows, type=_HITS)], names=[*names, name])

    return docs.mapInArrow(run, schema)


def contamination(docs: DataFrame, items: DataFrame, *, text: str = "text", item_id: str = "item_id", item_text: str = "text",
                  window: int = WINDOW, gram: int = GRAM, block_bytes: int = BLOCK_BYTES, name: str = "contamination") -> DataFrame:
    """The documents with a struct ``name``: words, hit words, their spans in words, ids of the items that occur.

    Null texts have no words. Items without words match nothing; repeated item rows count once; an item without id marks
    words but can't be listed. All columns of ``docs`` stay; one that is called ``name`` is replaced.
    """
    spark = docs.sparkSession
    docs = docs.drop(name)
    items = items.select(F.col(item_id).cast("long").alias("id"), F.col(item_text).alias("text"))
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-size // block_bytes))
    for block in range(blocks):
        part = items if blocks == 1 else items.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == block)
        rows = part.toArrow()
        texts = rows.column("text").combine_chunks()
        index = fingerprints(rows.column("id").to_pylist(), texts, window, gram)
        docs = _pass(docs, spark.sparkContext.broadcast(index), text, name)
        if block + 1 < blocks:
            docs = stored(docs, "contamination")
    return docs


def is_contaminated(name: str = "contamination"):
    """At least one word in twenty is hit."""
    return (F.col(f"{name}.n_hit") > 0) & (20 * F.col(f"{name}.n_hit") >= F.col(f"{name}.n_words"))
