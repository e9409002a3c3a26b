from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_fixtures import table  # noqa: F401

from wardmill.llm import merkle


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def climbed(nodes, fan):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([sha("".join(levels[-1][i:i + fan])) for i in range(0, len(levels[-1]), fan)])
    return levels


def brute(rows, fan, replaced):
    """Leaf, subroot, root, proof and folded root of each row (group, id, leaf)."""
    groups = {}
    for k, (group, id_, leaf) in enumerate(rows):
        groups.setdefault(group, []).append((id_ is not None, id_ or 0, leaf, k))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: climbed([x[2] for x in sorted(groups[g])], fan) for g in names}
    top = climbed([trees[g][-1][0] for g in names], fan) if names else []
    out = []
    for number, g in enumerate(names):
        for place, (_, _, leaf, k) in enumerate(sorted(groups[g])):
            proof, value = "", replaced.get(k, leaf)
            for levels, at in ((trees[g], place), (top, number)):
                for nodes in levels[:-1]:
                    first = at // fan * fan
                    run, slot = nodes[first:first + fan], at % fan
                    proof += "".join(run[:slot] + run[slot + 1:])
                    value = sha("".join(run[:slot] + [value] + run[slot + 1:]))
                    at //= fan
            out.append((leaf, trees[g][-1][0], top[-1][0], proof, value))
    return sorted(out)


def found(spark, rows, fan, levels, replaced, parts=5):
    data = [(g, i, bytearray.fromhex(leaf), bytearray.fromhex(replaced[k]) if k in replaced else None) for k, (g, i, leaf) in enumerate(rows)]
    frame = spark.createDataFrame(data, "g string, id long, digest binary, replaced binary").repartition(parts)
    got = merkle.manifest(frame.withColumn("grp", merkle.group_key(F.col("g"))), fan=fan, levels=levels).collect()
    return sorted((r["leaf"].hex(), r["subroot"].hex(), r["root"].hex(), r["proof"], r["folded_root"].hex()) for r in got)


def test_vectorised_hash_is_sha256():
    digests = [hashlib.sha256(str(i).encode()).digest() for i in range(7)]
    words = merkle._words(np.frombuffer(b"".join(digests), dtype=np.uint8).reshape(-1, 32))
    for fan in (2, 3, 5):
        _, parent, parents = merkle._climbed(words, np.arange(7), fan)
        want = [hashlib.sha256("".join(d.hex() for d in digests[i:i + fan]).encode()).digest() for i in range(0, 7, fan)]
        assert [x.tobytes() for x in merkle._bytes(parents)] == want
        assert parent.tolist() == [i // fan for i in range(7)]


@pytest.mark.parametrize(("fan", "levels", "n"), [(2, 2, 120), (3, 2, 90), (2, 8, 300), (2, 8, 1)])
def test_equal_to_brute_force(spark, fan, levels, n):
    """Null, empty and hot groups, rows without an id, ids that repeat; several rounds of cells."""
    rnd = random.Random(n)
    rows = [(rnd.choice([None, "", "a", "b", "é", "b", "b"]), rnd.choice([None, rnd.randrange(9), rnd.randrange(10 ** 6)]), sha(str(rnd.random()))) for _ in range(n)]
    replaced = {k: sha(f"x{k}") for k in range(0, n, 7)}
    assert found(spark, rows, fan, levels, replaced) == brute(rows, fan, replaced)


def test_equal_rows_and_partitioning(spark):
    rows = [("a", 1, sha("x"))] * 20 + [("a", None, sha("y"))] * 5
    assert found(spark, rows, 2, 2, {}, 1) == found(spark, rows, 2, 2, {}, 9) == brute(rows, 2, {})


def test_no_rows(spark):
    assert found(spark, [], 2, 8, {}) == []


def test_leaf_of_nulls_empties_and_long_texts(spark, table):
    long = "é" * 300_000
    docs = table([(1, None, "", 5, long), (None, "a", None, None, None)], "doc_id long, source string, lang string, n_chars long, text string")
    got = {r["doc_id"]: r["leaf"] for r in docs.select("doc_id", F.lower(F.hex(merkle.leaf_digest(*[F.col(c) for c in docs.columns[:1] + ["source", "lang", "n_chars", "text"]]))).alias("leaf")).collect()}
    assert got == {1: sha(f"1:1-0:1:5600000:{long}"), None: sha("-1:a---")}
