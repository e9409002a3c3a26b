from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from test_decontaminate import brute
from test_near_duplicates import overlap, weighted
from test_text_operators import filled
from test_words_and_cells import components

import corpus_pipeline as P
from wardmill.llm import quality, toxicity
from wardmill.llm.queries import learned_from

FOLDER = "/root/testdata/sf0.001"


def kept_by(model, docs, keep):
    """One text at a time, outside of Spark."""
    return {i for i, x in docs.items() if keep(model.scores(pa.array([x]))[0])}


def texts(frame):
    return {r["doc_id"]: r["text"] for r in frame.select("doc_id", "text").collect()}


def test_stages_against_brute_force(spark):
    """Each stage on what its predecessor kept; ``run`` gives the last stage's rows."""
    start = docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    results = []
    for name, stage in P.STAGES:
        results.append((docs, P.stored(stage(spark, docs, FOLDER), "pipeline-test")))
        docs = results[-1][1]
    assert all(a.columns == b.columns for a, b in results[:-1])

    before, after = results[0]
    assert set(texts(after)) == kept_by(toxicity.train(before, labels, use=learned_from()), texts(before), lambda s: s < 0.5)
    before, after = results[1]
    assert set(texts(after)) == kept_by(quality.train(before, labels, use=learned_from()), texts(before), lambda s: s >= 0.3)

    before, after = results[2]
    bags = [(i, b) for i, b in weighted(list(texts(before).items())) if b]
    of = components([(a, b) for a, p in bags for b, q in bags if a < b and overlap(p, q) >= 0.8])
    assert set(texts(after)) == {i for i in texts(before) if of.get(i, i) == i}

    before, after = results[3]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    bad = {d for d, n, hit, _ in brute(list(texts(before).items()), items) if hit and 20 * hit >= n}
    assert set(texts(after)) == set(texts(before)) - bad and bad

    before, after = results[4]
    rows = before.select("doc_id", "text", "source").collect()
    words = defaultdict(int)
    for r in rows:
        words[r["source"]] += len(r["text"].split())
    expected, source = filled(words), {r["doc_id"]: r["source"] for r in rows}
    for r in after.collect():
        own = source[r["doc_id"]]
        assert r["source_size"] == words[own] and np.isclose(r["target"], expected[own]) and r["taken"] <= 2 * r["size"]
    assert sorted(map(str, P.run(spark, FOLDER).collect())) == sorted(map(str, after.collect()))
    assert start.count() > results[0][1].count() > results[4][1].count() > 0
