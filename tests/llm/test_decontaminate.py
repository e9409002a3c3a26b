from __future__ import annotations

import random
import re
import time
import tracemalloc

import pyarrow as pa
from pyspark.sql import functions as F

from llm_fixtures import table  # noqa: F401
from wardmill.llm import decontaminate as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(x):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in x or ""))


def brute(docs, items):
    windows = {}
    for i, x in items:
        w = words(x)
        for k in range(max(1, len(w) - 12)):
            if w:
                windows.setdefault(tuple(w[k:k + 13]), set()).add(i)
    out = []
    for d, x in docs:
        w, hit, ids = words(x), set(), set()
        for n in {len(k) for k in windows}:
            for k in range(len(w) - n + 1):
                if tuple(w[k:k + n]) in windows:
                    hit.update(range(k, k + n))
                    ids |= windows[tuple(w[k:k + n])]
        out.append((d, len(w), len(hit), sorted(ids - {None})))
    return sorted(out, key=str)


def sample(seed):
    rng = random.Random(seed)
    text = lambda n, v: " ".join(rng.choice(v) for _ in range(n))
    few, many = ["a", "b"], [f"w{i}" for i in range(30)]
    items = [(i, text(rng.choice([0, 1, 2, 5, 12, 13, 14, 40]), rng.choice([few, many]))) for i in range(25)] + [(90, None), (91, ""), (3, "again w1 w2"), (None, text(20, many))]
    docs = []
    for i in range(40):
        parts = [text(rng.randrange(30), many)]
        for _ in range(rng.randrange(3)):
            w = (rng.choice(items)[1] or "").upper().split()
            s = rng.randrange(len(w) + 1)
            parts += [", ".join(w[s:s + rng.choice([5, 13, 60])]), text(rng.randrange(5), many)]
        docs.append((i, "\n".join(parts)))
    return docs + [(100, None), (101, ""), (102, "a " * 3000), (5, docs[5][1])], items


def test_against_brute_force(spark, table):
    for seed, block in ((1, 1 << 20), (2, 300)):
        docs, items = sample(seed)
        got = D.contamination(table(docs, "doc_id long, text string"), table(items, "item_id long, text string"), block_bytes=block)
        rows = sorted(((r["doc_id"], r["contamination"]["n_words"], r["contamination"]["n_hit"], r["contamination"]["items"]) for r in got.collect()), key=str)
        assert rows == brute(docs, items)


def test_winnowing_keeps_a_fingerprint_of_every_long_shared_span():
    rng = random.Random(5)
    for _ in range(200):
        shared = [f"s{rng.randrange(6)}" for _ in range(13)]
        sides = [" ".join([f"x{rng.randrange(6)}" for _ in range(rng.randrange(20))] + shared + [f"y{rng.randrange(6)}" for _ in range(rng.randrange(20))]) for _ in range(2)]
        prints = []
        for x in sides:
            piece = next(iter(D.scan(pa.array([x]))))
            prints.append(set(D.winnow(piece.hashes(), 5, 13)[1].tolist()))
        assert prints[0] & prints[1]


def test_spans_extra_columns_and_rule(spark):
    item = " ".join(f"i{k}" for k in range(15))
    docs = spark.createDataFrame([(1, f"x y {item} z", "old", 5), (2, " ".join(["pad"] * 286) + " " + item, "o", 6)], "doc_id int, body string, contamination string, text int")
    got = D.contamination(docs, spark.createDataFrame([(4, item)], "k int, q string"), text="body", item_id="k", item_text="q")
    assert got.columns == ["doc_id", "body", "text", "contamination"]
    rows = {r["doc_id"]: r for r in got.withColumn("bad", D.is_contaminated()).collect()}
    assert [tuple(s) for s in rows[1]["contamination"]["spans"]] == [(2, 17)] and rows[1]["bad"]
    assert rows[2]["contamination"]["n_hit"] == 15 and not rows[2]["bad"]


def test_empty_tables(spark):
    docs, items = spark.createDataFrame([(1, "a")], "doc_id long, text string"), spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert D.contamination(docs.limit(0), items).count() == 0
    assert D.contamination(docs, items.limit(0)).select(F.col("contamination.n_hit")).first()[0] == 0


def hits(docs, items):
    index = D.fingerprints([i for i, _ in items], pa.array([x for _, x in items], type=pa.string()))
    found = D.find_hits(pa.array([x for _, x in docs], type=pa.string()), index)
    return sorted(((d, n, sum(e - s for s, e in spans), sorted({index.ids[x] for x in own} - {None}))
                   for (d, _), (n, spans, own) in zip(docs, found, strict=True)), key=str)


def test_periodic_texts_against_brute_force():
    """Runs of a word, periods up to 30, broken ones, in documents and items: equal to brute force with any step."""
    rng = random.Random(7)

    def periodic(n, broken):
        w = [f"p{rng.randrange(4)}" for _ in range(rng.choice([1, 1, 2, 3, 7, 14, 30]))]
        out = [w[i % len(w)] for i in range(n)]
        for _ in range(broken):
            out[rng.randrange(n)] = f"q{rng.randrange(3)}"
        return " ".join(out)

    items = [(i, periodic(rng.choice([3, 12, 13, 14, 40, 300]), rng.randrange(3))) for i in range(25)]
    docs = [(i, periodic(rng.choice([5, 13, 60, 900]), rng.randrange(9))) for i in range(60)]
    docs += [(100 + i, " ".join([x, "end", y])) for i, ((_, x), (_, y)) in enumerate(zip(items, items[1:]))]
    expected = brute(docs, items)
    assert sum(h > 0 for _, _, h, _ in expected) > 30
    whole = D.STEP
    try:
        for D.STEP in (whole, 37):
            assert hits(docs, items) == expected
    finally:
        D.STEP = whole


def test_a_word_repeated_a_hundred_thousand_times():
    """Time and memory of the work follow the text's length, not its square."""
    docs = [(1, "a " * 100_000), (2, "a b " * 50_000 + "c"), (3, "a " * 12)]
    items = [(1, "a " * 10_000), (2, "b a " * 5_000), (3, "a " * 20 + "x")]
    tracemalloc.start()
    began = time.monotonic()
    found = hits(docs, items)
    assert time.monotonic() - began < 60 and tracemalloc.get_traced_memory()[1] < 500 << 20
    tracemalloc.stop()
    assert found == [(1, 100_000, 100_000, [1, 3]), (2, 100_001, 100_000, [2]), (3, 12, 0, [])]
