from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
from llm_fixtures import table  # noqa: F401
from test_words_and_cells import components

from wardmill.llm import embedding_dedup as E
from wardmill.llm import weighted_minhash as M


def shingles(x):
    w = re.findall(r"\w+", (x or "").lower())
    return Counter(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))) if w else Counter()


def weighted(rows):
    """Weight of each shingle of each row, from exact counts over the rows that have words."""
    bags = [(i, shingles(x)) for i, x in rows]
    n = sum(bool(b) for _, b in bags)
    df = Counter(s for _, b in bags for s in b)
    idf = {s: 1 + 0.25 * (math.log(k / n) / math.log(0.02) if k >= 0.02 * n else 1) for s, k in df.items()}
    return [(i, {s: (1 + math.log(k)) * idf[s] for s, k in b.items()}) for i, b in bags]


def overlap(p, q):
    both = sum(min(v, q[s]) for s, v in p.items() if s in q)
    return both / (sum(p.values()) + sum(q.values()) - both)


def texts(seed=3):
    rng = random.Random(seed)
    out = []
    for _ in range(12):
        base = [f"{rng.choice('abcdefgh')}{rng.randrange(400)}" for _ in range(rng.choice([60, 120, 400]))]
        out.append(" ".join(base))
        for _ in range(rng.randrange(6)):
            copy = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 30])):
                copy[rng.randrange(len(copy))] = f"z{rng.randrange(10 ** 6)}"
            out.append(", ".join(copy).upper())
    return out + ["", None, "", "one two", "One, two!", "x " * 2000]


def test_classes_are_those_of_exact_similarity(spark, table):
    rows = list(enumerate(texts())) + [(None, "some text without an id here"), (0, texts()[0])]
    bags = [(i, b) for i, b in weighted(rows) if i is not None and b]
    pairs = [(a, b) for a, p in bags for b, q in bags if a < b and overlap(p, q) >= 0.8]
    assert 10 < len(pairs)
    expected = components(pairs)
    for cell in (1000, 3):
        got = M.near_duplicates(table([(i, x, 1) for i, x in rows], "doc_id long, text string, id int"), cell=cell).collect()
        assert len(got) == len(rows)
        assert {r["id"]: r["class_id"] for r in got if r["id"] is not None} == {i: expected.get(i, i) for i, _ in rows if i is not None}
        assert all(r["kept"] == (r["id"] is None or r["class_id"] == r["id"]) for r in got)


def test_rows_that_share_an_id_are_all_compared_in_any_order(spark):
    """Different texts of one id, texts that several ids have, and an id with many texts: equal to brute force in both orders."""
    rng = random.Random(11)
    some = [x for x in texts(5) if x and len(x.split()) > 20]
    other = [x for x in texts(6) if x and len(x.split()) > 20]
    rows = [(1, some[0]), (1, other[0]), (2, other[0].replace(" ", " - ", 1)), (3, some[0]), (4, other[0]), (0, other[0])]
    rows += [(rng.randrange(10, 40), x) for x in some + other] + [(50, x) for x in other[::3]] + [(50, None), (51, ""), (None, some[0])] * 2
    bags = [(i, b) for i, b in weighted(rows) if i is not None and b]
    expected = components([(i, j) for at, (i, p) in enumerate(bags) for j, q in bags[:at] if i != j and overlap(p, q) >= 0.8])
    for order, parts, cell in ((rows, 1, 1000), (rows[::-1], 5, 3), (sorted(rows, key=str), 13, 1000)):
        docs = spark.createDataFrame(order, "doc_id long, text string").repartition(parts)
        got = M.near_duplicates(docs, cell=cell).collect()
        assert len(got) == len(rows)
        assert {r["id"]: r["class_id"] for r in got if r["id"] is not None} == {i: expected.get(i, i) for i, _ in rows if i is not None}


def test_frequencies_do_not_depend_on_partitions_or_memory(spark):
    """Shares in any partitioning and with a summary that overflows all the time are those of exact counts."""
    rng = random.Random(2)
    often = " ".join(f"w{k}" for k in range(60))
    docs = [(often if rng.random() < 0.03 else "") + " " + " ".join(f"v{rng.randrange(10 ** 6)}" for _ in range(rng.randrange(200))) for _ in range(2000)]
    docs += ["", None, " ".join(f"u{k}" for k in range(20_000))]
    count = Counter(s for x in docs for s in shingles(x))
    n = sum(bool(shingles(x)) for x in docs)
    want = sorted(k / n for k in count.values() if k >= 0.02 * n)
    assert len(want) >= 50
    frame = spark.createDataFrame([(x,) for x in docs], "text string")
    tables = [M.common_shingles(frame.repartition(parts), summary=summary) for parts, summary in ((1, 1 << 20), (64, 1 << 20), (1, 3000), (7, 50))]
    for keys, shares in tables:
        assert (keys == tables[0][0]).all() and (shares == tables[0][1]).all()
        assert np.allclose(sorted(shares), want, rtol=0, atol=1e-12)


def test_no_documents(spark):
    assert M.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_samples_agree_as_often_as_weights_overlap():
    rng = np.random.default_rng(1)
    keys = rng.integers(1, 1 << 62, 400, dtype=np.uint64)
    agree, true = [], []
    for part in (40, 100, 200):
        u, v = np.zeros(400), np.zeros(400)
        u[:300], v[part:part + 300][:400 - part] = rng.uniform(0.5, 3, 300), 0
        v[part:] = u[part:] * rng.choice([1.0, 1.5], 400 - part) + (u[part:] == 0)
        true.append(np.minimum(u, v).sum() / np.maximum(u, v).sum())
        hits = 0
        for _ in range(40):                              # other keys, other draws
            keys = M.mix(keys)
            a, b = (M.samples(keys[w > 0], w[w > 0], np.array([0]))[0] for w in (u, v))
            hits += int((a == b).sum())
        agree.append(hits / (40 * M.BANDS * M.ROWS))
    assert np.abs(np.array(agree) - true).max() < 0.05


def test_common_shingles_are_exact(spark, table):
    phrase = "this very same line of text"
    rows = [(i, f"{phrase if i % 3 == 0 else ''} w{i} v{i} u{i} t{i} s{i} r{i}") for i in range(300)]
    keys, shares = M.common_shingles(table(rows, "doc_id long, text string", 7))
    assert len(keys) >= 2 and np.isclose(shares.max(), 1 / 3)
    assert all(np.diff(keys.astype(object)) > 0)


def vectors(seed=4):
    rng = np.random.default_rng(seed)
    rows, n = [], 0
    for label in (0, 1, None):
        for _ in range(60):
            base = rng.standard_normal(16)
            for k in range(rng.integers(1, 5)):
                rows.append((n, [float(np.float32(x)) for x in base * rng.uniform(0.5, 2) + rng.standard_normal(16) * 0.03 * k], label))
                n += 1
    same = rows[0][1]
    odd = [None, [], [0.0] * 16, [float("nan")] + same[1:], [None, *same[1:]], [float("inf")] + same[1:], same[:8], same, same]
    return rows + [(n + i, v, 0) for i, v in enumerate(odd)] + [(None, same, 0)]


def linked(rows):
    good = [(i, np.array(v), label) for i, v, label in rows
            if i is not None and v and label is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    return [(a[0], b[0]) for k, a in enumerate(good) for b in good[k + 1:]
            if a[2] == b[2] and len(a[1]) == len(b[1]) and a[1] @ b[1] / np.linalg.norm(a[1]) / np.linalg.norm(b[1]) >= 0.98]


def test_vectors_against_brute_force(spark, table):
    rows = vectors()
    pairs = linked(rows)
    degree = {}
    for a, b in pairs:
        degree[a], degree[b] = degree.get(a, 0) + 1, degree.get(b, 0) + 1
    expected = components(pairs)
    for cell in (1500, 4):
        got = E.near_duplicate_vectors(table([(*r, "x") for r in rows], "vec_id long, embedding array<float>, label int, id string"), cell=cell).collect()
        assert len(got) == len(rows)
        for r in got:
            if r["id"] is None:
                assert (r["n_links"], r["component_id"], r["kept"]) == (0, None, True)
            else:
                assert (r["n_links"], r["component_id"]) == (degree.get(r["id"], 0), expected.get(r["id"], r["id"]))
                assert r["kept"] == (r["component_id"] == r["id"])


def test_estimates_are_unbiased_and_bounded():
    rng = np.random.default_rng(2)
    bits = 256
    turn = E.rotation(64, bits)
    assert np.allclose(turn.T @ turn, np.eye(64))
    x = E._unit(rng.standard_normal((400, 64)))
    y = E._unit(x + rng.standard_normal((400, 64)) * 0.1)
    codes = np.where(x @ turn.T > 0, 1, -1) / np.sqrt(bits)
    factor = (codes * (x @ turn.T)).sum(axis=1)
    error = (codes * (y @ turn.T)).sum(axis=1) / factor - (x * y).sum(axis=1)
    bound = np.sqrt((1 - factor ** 2) / factor ** 2) / np.sqrt(bits - 1)
    assert abs(error.mean()) < 0.01 and (np.abs(error) < E.SIGMAS * bound).all() and np.std(error / bound) < 1.3


def test_no_vectors(spark):
    assert E.near_duplicate_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0
