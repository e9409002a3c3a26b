"""Ranks, running totals, medians and AUC against brute force, with one key holding a third of the rows."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import rows
from wardmill.operators.metrics import roc_auc
from wardmill.operators.ordered import dense_codes, exact_medians, rank_within, running_totals
from wardmill.operators.panel import temporal_split
from wardmill.operators.skew import heavy_keys, hot_key_left_join


def skewed(spark, n=20000):
    """Group 0 and value 7 each hold about a third of the rows."""
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("g"),
        F.when(F.hash("id") % 3 == 0, 7.0).otherwise((F.abs(F.hash("id")) % 1000).cast("double")).alias("v"),
        "id",
    )


def test_rank_equals_the_window(spark):
    df = skewed(spark)
    from pyspark.sql import Window

    want = df.withColumn("want", F.rank().over(Window.partitionBy("g").orderBy(F.col("v").desc())))
    got = rank_within(df, ["g"], "v", "got", buckets=16).join(want.select("id", "want"), "id")
    assert got.count() == 20000 and got.filter("got <> want").count() == 0


def test_rank_with_null_group_and_null_measure(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 2.0), ("a", None), ("a", 3.0)], "g string, v double")
    got = {(r["g"], r["v"]): r["rank"] for r in rank_within(df, ["g"], "v").collect()}
    assert got == {(None, 2.0): 1, (None, 1.0): 2, ("a", 3.0): 1, ("a", None): 2}


def test_running_totals_both_directions(spark):
    df = skewed(spark, 5000)
    pdf = df.toPandas().groupby("v").size()
    for descending in (False, True):
        got = running_totals(df, [], "v", {"n": F.lit(1)}, descending, buckets=8).toPandas().set_index("v")["cum_n"]
        want = (pdf[::-1] if descending else pdf).cumsum()
        assert (got.sort_index() == want.sort_index()).all()


def test_medians(spark):
    df = skewed(spark)
    want = df.toPandas().groupby("g")["v"].median()
    got = exact_medians(df, ["g"], "v", buckets=16).toPandas().set_index("g")["median"]
    assert (got.sort_index() == want.sort_index()).all()
    one = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,), (None,)], "v double")
    assert exact_medians(one, [], "v").first()["median"] == 2.5
    assert exact_medians(one.filter("v IS NULL"), [], "v").first()["median"] is None


def test_dense_codes_follow_text_order(spark):
    texts = ["a", "", "aaaaaaaaaaab", "aaaaaaaaaaaa", "Zebra", "é", "a"]
    df = spark.createDataFrame([("f", t) for t in texts] + [("f", None)], "feature string, value string")
    got = {r["value"]: r["code"] for r in dense_codes(df, ["feature"], "value").collect()}
    assert got == {t: i for i, t in enumerate(sorted(set(texts), key=lambda t: t.encode()))}


def brute_auc(label, score):
    pos, neg = [s for y, s in zip(label, score) if y == 1], [s for y, s in zip(label, score) if y == 0]
    if not pos or not neg:
        return None
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 1), st.integers(0, 6)), min_size=1, max_size=40))
def test_auc(spark, data):
    df = spark.createDataFrame([(y, s / 6) for y, s in data], "y int, s double")
    got = roc_auc(df, "y", "s").first()["roc_auc"]
    want = brute_auc([y for y, _ in data], [s for _, s in data])
    assert got == want if want is None else got == pytest.approx(want)
    if want is not None:
        flipped = roc_auc(df.withColumn("y", 1 - F.col("y")), "y", "s").first()["roc_auc"]
        assert flipped == pytest.approx(1 - want)


def test_auc_example(spark):
    df = spark.createDataFrame([(0, 0.1), (0, 0.4), (1, 0.35), (1, 0.8)], "y int, s double")
    assert roc_auc(df, "y", "s").first()["roc_auc"] == 0.75


def test_hot_key_join_equals_plain_join(spark):
    df = skewed(spark)
    dim = spark.createDataFrame([(i, f"n{i}") for i in range(0, 40)], "g long, name string")
    fact = df.withColumn("g", F.when(F.col("id") == 5, F.lit(None)).otherwise(F.col("g")).cast("long"))
    got = hot_key_left_join(fact, dim, ["g"], share=0.1)
    want = fact.join(dim, ["g"], "left")
    assert got.count() == want.count() == 20000
    assert got.exceptAll(want.select(got.columns)).count() == 0
    assert [r["g"] for r in heavy_keys(df, ["g"], 0.1).collect()] == [0]


def test_temporal_split_is_disjoint_and_complete(spark):
    df = spark.range(1000).select(F.date_add(F.lit("2022-01-01").cast("date"), F.col("id").cast("int")).alias("d"))
    got = temporal_split(df, "d", "2022-12-31", "2023-09-30")
    pdf = got.toPandas()
    assert set(pdf["split"]) == {"train", "val", "test"} and len(pdf) == 1000
    d = pd.to_datetime(pdf["d"])
    assert d[pdf["split"] == "train"].max() < d[pdf["split"] == "val"].min()
    assert np.datetime64("2023-09-30") == d[pdf["split"] == "val"].max()


def test_ranks_keep_the_measures_type(spark):
    big = 2 ** 53
    df = spark.createDataFrame([("a", big), ("b", big + 1), ("c", None), ("d", -5)], "k string, v bigint")
    assert {r["k"]: r["rank"] for r in rank_within(df, [], "v").collect()} == {"b": 1, "a": 2, "d": 3, "c": 4}
    low = spark.createDataFrame([("a", float("-inf")), ("b", None)], "k string, v double")
    assert {r["k"]: r["rank"] for r in rank_within(low, [], "v").collect()} == {"a": 1, "b": 2}


def test_texts_with_a_common_beginning_spread(spark):
    from wardmill.operators.ordered import with_value_bucket

    df = spark.range(20_000).select(F.concat(F.lit("category-"), F.lpad(F.col("id").cast("string"), 6, "0")).alias("v"))
    sizes = with_value_bucket(df, "v", 256).groupBy("_value_bucket").count().agg(F.count("*"), F.max("count")).first()
    assert sizes[0] > 200 and sizes[1] < 1000
    codes = dense_codes(df, [], "v").orderBy("v").collect()
    assert [r["code"] for r in codes] == list(range(20_000))


def test_groups_without_values_stay(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", None), (None, 2.0)], "g string, v double")
    assert rows(exact_medians(df, ["g"], "v")) == [("a", 2.0), ("b", None), (None, 2.0)]
