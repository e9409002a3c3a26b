from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from llm_fixtures import table  # noqa: F401

from wardmill.llm import language
from wardmill.llm.queries import QUERIES

EN = "the house of the old man and the river that runs through it with some of the water"
DE = "das haus von dem alten mann und der fluss der durch das land fließt mit dem wasser"
DDL = "doc_id long, text string, lang string, score string, rejected int"


def shuffled(text, n, seed):
    rng = np.random.default_rng(seed)
    words = text.split()
    return [" ".join(rng.permutation(words)[:rng.integers(5, len(words))]) for _ in range(n)]


@pytest.fixture()
def docs(table):
    rows = [(i, t, "en" if i < 60 else "de", "old", 1) for i, t in enumerate(shuffled(EN, 60, 1) + shuffled(DE, 60, 2))]
    odd = [(200, None, "en", "", 0), (201, "", "de", "", 0), (202, "123 !? 4", None, "", 0), (203, "the man", None, "", 0), (None, "das wasser und der fluss", None, "", 0),
           (204, "これは日本語の文章です", None, "", 0), (205, "the old man and the river", None, "", 0), (205, "der alte mann und das haus", None, "", 0)]
    return table(rows + odd, DDL)


def test_predictions_and_defined_cases(docs):
    model = language.train(docs, bits=12)
    got = language.with_language(docs, model)
    assert got.columns == ["doc_id", "text", "lang", "lang_pred", "score", "rejected"]
    found = got.collect()
    assert len(found) == docs.count()
    assert all(r["lang_pred"] == r["lang"] for r in found if r["doc_id"] is not None and r["doc_id"] < 120)
    assert sorted((r["text"] or "", r["lang_pred"], r["score"]) for r in found if r["doc_id"] in (200, 201, 202)) == [("", "und", 0.0), ("", "und", 0.0), ("123 !? 4", "und", 0.0)]
    assert {r["text"]: r["lang_pred"] for r in found if r["doc_id"] in (203, 205, None)} == {
        "the man": "en", "das wasser und der fluss": "de", "the old man and the river": "en", "der alte mann und das haus": "de"}
    assert all(0 <= r["score"] <= 1 for r in found)
    assert [r["rejected"] for r in found if r["doc_id"] == 204] == [True]
    assert sum(r["rejected"] for r in found if r["doc_id"] is not None and r["doc_id"] < 120) < 12


def test_row_order_and_partitions_do_not_matter(docs):
    one, two = (language.train(d, bits=10) for d in (docs.coalesce(1), docs.orderBy(F.desc("text")).repartition(7)))
    assert np.array_equal(one.vectors, two.vectors) and one.temperature == two.temperature


def test_sums_equal_a_plain_mean(docs):
    """Against the features of one text at a time, repeats counted."""
    model = language.train(docs, bits=10)
    for text in ("the man the man", "das haus das", "x"):
        features = []
        for word in text.split():
            piece = next(iter(language.scan(pa.array([word]))))
            features += language.subword_features(piece, np.arange(1), piece.hashes(), model.sizes, model.bits)[0].tolist()
        logits, seen = model.means(pa.array([text]))
        assert np.allclose(logits[0], model.vectors[features].mean(axis=0) @ model.output + model.bias)
        assert seen[0] == pytest.approx(model.seen[features].mean())


@pytest.mark.parametrize("text", ["the man and " * 900_000, "é" * 5_000_000])
def test_long_texts_are_cut_without_loss(docs, text):
    model = language.train(docs, bits=10)
    pieces, owner = language._pieces(pa.array([None, text, "a"]))
    assert "".join(x or "" for x in pieces.to_pylist()) == text + "a" and owner[0] == 0 and owner[-1] == 2 and len(owner) > 4
    logits, _ = model.means(pa.array(["", text, "a"]))
    if text[0] == "t":
        short, _ = model.means(pa.array(["the man and " * 5]))
        assert np.allclose(logits[1], short[0])


def test_sample_is_bounded_and_even(table):
    """A hot language and a hot text leave room for the others; each language has at least one row."""
    rows = [(i, f"w{i} " * 3, "hot") for i in range(900)] + [(2000 + i, "same text", "hot") for i in range(900)] + [(5000 + i, f"v{i}", f"l{i % 7}") for i in range(70)]
    few = language.sample(table(rows, "doc_id long, text string, lang string"), id_="doc_id", text="text", lang="lang", use=None, per_language=20, rows=80, text_bytes=1 << 20)
    assert {r["name"]: r["count"] for r in few.groupBy("name").count().collect()} == {"hot": 10} | {f"l{i}": 10 for i in range(7)}
    tight = language.sample(table(rows, "doc_id long, text string, lang string"), id_="doc_id", text="text", lang="lang", use=None, per_language=20, rows=5, text_bytes=1)
    assert tight.count() == 5


def test_nothing_or_one_language_to_learn(table):
    empty = table([], DDL)
    assert language.train(empty) is None
    assert language.with_language(empty, None).collect() == []
    one = table([(1, "the man", "en", "", 0), (2, "7", "en", "", 0)], DDL)
    assert [(r["lang_pred"], r["score"]) for r in language.with_language(one, None).collect()] == [("und", 0.0)] * 2
    found = language.with_language(one, language.train(one, bits=8)).collect()
    assert sorted((r["lang_pred"], r["score"]) for r in found) == [("en", 1.0), ("und", 0.0)]


def test_held_out_accuracy(spark):
    found = QUERIES["op11_subword_language"](spark, "/root/testdata/sf0.01").join(spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang"), "doc_id")
    right = found.where("held_out").selectExpr("avg(cast(lang = lang_pred as int)) a", "count(1) n").first()
    assert right["n"] > 300 and right["a"] > 0.99
