from __future__ import annotations

import datetime
import os
import uuid

import pytest
from conftest import plan_of, rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from wardmill.operators import aggregates as A
from wardmill.sources import catalog as C


@pytest.fixture()
def name():
    return "t_" + uuid.uuid4().hex


DDL = "d date NOT NULL, k string NOT NULL, v double"
DAYS = [datetime.date(2024, 1, i) for i in (1, 2, 3)]


def frame(spark, *data):
    return spark.createDataFrame(list(data), "k string, d date, v double")


def test_required_columns_are_enforced_at_insert(spark, name, folder):
    for _ in range(2):
        C.create_table(spark, name, DDL, ["d"], location=f"{folder}/t")
    assert spark.table(name).columns == ["k", "v", "d"] and C.required_of(spark, name) == ["d", "k"]
    C.append(spark, name, frame(spark, ("a", DAYS[0], 1.0), ("b", DAYS[1], None)))
    before = sorted(os.listdir(f"{folder}/t"))
    for bad in (("x", None, 1.0), (None, DAYS[0], 1.0)):
        for write in (C.append, C.replace_partitions):
            with pytest.raises(Exception, match="NULL in required column"):
                write(spark, name, frame(spark, ("y", DAYS[0], 5.0), bad, ("z", DAYS[2], 5.0)).repartition(3))
    assert rows(spark.table(name)) == [("a", 1.0, DAYS[0]), ("b", None, DAYS[1])]
    assert sorted(x for x in os.listdir(f"{folder}/t") if "=" in x) == [x for x in before if "=" in x]
    with pytest.raises(ValueError, match="'k'"):
        C.append(spark, name, frame(spark).drop("k"))
    C.replace_partitions(spark, name, frame(spark, ("c", DAYS[1], 3.0)))
    assert rows(spark.table(name)) == [("a", 1.0, DAYS[0]), ("c", 3.0, DAYS[1])]


def test_views_follow_their_table(spark, name, folder):
    C.create_table(spark, name, DDL, location=f"{folder}/t")
    C.create_view(spark, f"{name}_v", f"SELECT k FROM {name} WHERE v > 1")
    C.create_view(spark, f"{name}_v", f"SELECT k, v FROM {name} WHERE v > 1")
    C.append(spark, name, frame(spark, ("a", DAYS[0], 1.0), ("b", DAYS[0], 2.0)))
    assert rows(spark.table(f"{name}_v")) == [("b", 2.0)]
    assert not spark.catalog.getTable(f"{name}_v").isTemporary
    spark.sql(f"DROP VIEW {name}_v")


def test_upsert_touches_only_its_partitions(spark, name, folder):
    C.create_table(spark, name, DDL, ["d"], C.Buckets(4, ("k",), ("k",)), f"{folder}/t")
    C.append(spark, name, frame(spark, *[(f"k{i}", DAYS[i % 3], float(i)) for i in range(30)]))
    parts = lambda d: sorted(os.listdir(f"{folder}/t/d=2024-01-0{d}"))
    before = parts(3)
    for _ in range(2):
        C.upsert(spark, name, frame(spark, ("k0", DAYS[0], 99.0), ("new", DAYS[1], 98.0)), ["k", "d"], "d")
    got = {(r["k"], r["d"]): r["v"] for r in spark.table(name).collect()}
    assert len(got) == 31 and got["k0", DAYS[0]] == 99.0 and got["new", DAYS[1]] == 98.0 and got["k3", DAYS[0]] == 3.0
    assert parts(3) == before
    with pytest.raises(ValueError, match="repeats"):
        C.upsert(spark, name, frame(spark, ("a", DAYS[0], 1.0), ("a", DAYS[0], 2.0)), ["k", "d"], "d")
    C.upsert(spark, name, frame(spark), ["k", "d"], "d")
    assert spark.table(name).count() == 31


def test_joins_and_windows_on_buckets_need_no_exchange(spark, name, folder):
    size = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    C.create_table(spark, name, DDL, ["d"], C.Buckets(4, ("k",), ("k",)), f"{folder}/t")
    C.create_table(spark, f"{name}_e", "k string NOT NULL, w double", buckets=C.Buckets(4, ("k",), ("k",)), location=f"{folder}/e")
    C.append(spark, name, frame(spark, *[(f"k{i % 7}", DAYS[i % 3], float(i)) for i in range(30)]))
    C.append(spark, f"{name}_e", spark.createDataFrame([(f"k{i}", float(i)) for i in range(7)], "k string, w double"))
    C.upsert(spark, name, frame(spark, ("k1", DAYS[0], -1.0)), ["k", "d", "v"], "d")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        joined = spark.table(name).join(spark.table(f"{name}_e"), "k").withColumn("n", F.sum("w").over(Window.partitionBy("k").orderBy("d", "v")))
        assert "Exchange" not in plan_of(joined)
        plain = spark.read.parquet(f"{folder}/t").join(spark.read.parquet(f"{folder}/e"), "k").withColumn("n", F.sum("w").over(Window.partitionBy("k").orderBy("d", "v")))
        assert "Exchange" in plan_of(plain)
        assert rows(joined.select("k", "d", "v", "w", "n")) == rows(plain.select("k", "d", "v", "w", "n")) and joined.count() == 31
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", size)


def test_profiles_merge_in_any_order(spark, folder):
    df = spark.range(4000).selectExpr("concat('h', id % 300) AS h", "date_add(DATE'2024-01-01', cast(id % 70 AS int)) AS d", "CASE WHEN id % 9 > 0 THEN id / 4000 END AS v")
    A.profile_state(df, "h", "d", "v").write.parquet(f"{folder}/p")
    states = spark.read.parquet(f"{folder}/p")
    whole = A.profile_of(A.merged_profile(states)).first()
    assert (whole["n_rows"], str(whole["first_date"]), str(whole["last_date"])) == (4000, "2024-01-01", "2024-03-10")
    assert abs(whole["n_entities"] - 300) <= 15
    assert all(abs(q - r) < 0.04 for q, r in zip(whole["quantiles"], (0.05, 0.5, 0.95)))
    halves = [A.merged_profile(states.filter(F.col("period") < "2024-02-01")), A.merged_profile(states.filter(F.col("period") >= "2024-02-01"))]
    for one, two in (halves, halves[::-1]):
        again = A.profile_of(A.merged_profile(one.unionByName(two))).first()
        assert again["n_rows"] == 4000 and again["n_entities"] == pytest.approx(whole["n_entities"], rel=0.01)
    nothing = A.profile_of(A.merged_profile(A.profile_state(df.withColumn("v", F.lit(None).cast("double")), "h", "d", "v"))).first()
    assert nothing["quantiles"] is None and nothing["n_rows"] == 4000
