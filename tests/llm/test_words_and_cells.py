from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from wardmill.llm.cells import cells, complete_groups
from wardmill.llm.graph import connected_components
from wardmill.llm.words import VISIBLE_BYTES, grams, row_grams, scan

TEXTS = ["", None, "One two", "a b", "Été ÇA va-t-il 3x", "  lead", "trail  ", "x" * 5000, "日本 語", "tail\tend\n", "A B", "a b c d e f"]
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(x):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in x or "")


def test_words_are_those_of_the_pattern():
    for chunk in (1, 7, 1 << 20):
        got = [[piece.data[s:e].tobytes().decode() for s, e in zip(piece.start[a:b], piece.end[a:b])]
               for piece in scan(pa.array(TEXTS), chunk_bytes=chunk) for a, b in zip(piece.first[:-1], piece.first[1:])]
        assert got == [WORD.findall(lower(x)) for x in TEXTS]
    got = [int(n) for piece in scan(pa.array(TEXTS), VISIBLE_BYTES, False) for n in np.diff(piece.first)]
    assert got == [len(re.findall(r"[^\x20\x09-\x0D]+", x or "")) for x in TEXTS]


def test_equal_words_have_equal_hashes_in_any_chunk():
    rng = random.Random(1)
    texts = [" ".join(rng.choice(["ab", "ba", "abc", "é", "zzz"]) for _ in range(50)) for _ in range(20)]
    known = {}
    for chunk in (1, 300, 1 << 20):
        for piece in scan(pa.array(texts).slice(3), chunk_bytes=chunk):
            for s, e, h in zip(piece.start, piece.end, piece.hashes()):
                assert known.setdefault(piece.data[s:e].tobytes(), h) == h
    assert len(set(known.values())) == 5


def test_grams_stay_inside_rows():
    piece = next(scan(pa.array(["a b c d e f", "a b", "", "b c d e f", "c"])))
    found, rows = row_grams(piece.hashes(), piece.first, 5)
    assert sorted(rows.tolist()) == [0, 0, 1, 3, 4]
    assert found[rows == 3][0] in found[rows == 0] and len(set(found.tolist())) == 4
    assert len(grams(piece.hashes()[:2], 5)) == 0


def components(pairs):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in pairs:
        if a is not None and b is not None and a != b:
            low, high = sorted((find(a), find(b)))
            root[high] = low
    return {x: find(x) for x in root}


def test_components_of_chains_stars_and_noise(spark):
    rng = random.Random(2)
    pairs = [(i, i + 1) for i in range(100, 160)] + [(1000, i) for i in range(1001, 1300)] + [(7, 7), (None, 3), (5, None)]
    pairs += [(rng.randrange(2000, 2300), rng.randrange(2000, 2300)) for _ in range(200)]
    got = connected_components(spark.createDataFrame(pairs, "src long, dst long"))
    assert {r["node"]: r["component"] for r in got.collect()} == components(pairs)
    assert connected_components(spark.createDataFrame([], "src long, dst long")).count() == 0


def test_every_pair_of_a_large_group_meets_once(spark):
    rows = spark.range(90).select(F.when(F.col("id") < 80, 1).otherwise(F.col("id")).alias("k"), "id")
    got = cells(rows, "k", "id", 20)

    def pairs(batches):
        for table, bounds in complete_groups(batches):
            ids, block, alone = (table.column(n).to_pylist() for n in ("id", "block", "alone"))
            out = [(ids[i], ids[j]) for a, b in zip(bounds[:-1], bounds[1:]) for i in range(a, b) for j in range(i + 1, b) if alone[a] or block[i] != block[j]]
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in (0, 1)], names=["a", "b"])

    met = [tuple(sorted(r)) for r in got.mapInArrow(pairs, "a long, b long").collect()]
    assert len(met) == len(set(met)) == 80 * 79 // 2
    assert got.groupBy("cell").count().agg(F.max("count")).first()[0] < 80
