"""What the physical plans must look like to hold at scale."""

from __future__ import annotations

import re

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from wardmill.checks import panels, views
from wardmill.checks.registry import Tables, load_all
from wardmill.operators.dedup import keep_latest
from wardmill.sources.readers import pushed_range
from wardmill.sources.writers import touched_partitions

FOLDER = "/root/testdata/sf0.001"
#: Tree attribution sends a column (the vector) through an Arrow function. The other two run whole jobs and return a scan of their table.
APART = ("scored_snapshot", "tree_shapley", "feature_store_after_late_rows", "stream_of_late_and_repeated_rows")
CHECKED = sorted(n for n, k in load_all().items() if k.sql is not None and n not in APART)


@pytest.mark.parametrize("name", CHECKED)
def test_no_python_no_cross_join_no_global_window(spark, name):
    plan = plan_of(load_all()[name](spark, FOLDER))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonEval", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert bad not in plan
    # A window without partition keys moves all its rows into one task. The only one allowed
    # runs over the bucket sums of an ordered operator: one row per bucket, never more.
    for node in re.findall(r"\+- Window \[(.*)", plan):
        spec = re.search(r"windowspecdefinition\(([^()]*)", node).group(1)
        is_global = re.match(r"^[^,]*#\d+L? (ASC|DESC)", spec)
        assert not is_global or spec.startswith("_value_bucket#"), node[:200]


def test_panel_is_exchanged_once(spark):
    t = Tables(spark, FOLDER)
    fact = views.fact(t)
    plan = plan_of(panels.features(t))
    panel_side = plan.split("SortMergeJoin [hospital_id")[1]
    first_window = panel_side.index("Window [lag")
    assert panel_side.count("Window [lag") == 1
    assert "Exchange" not in panel_side[:first_window]
    above = plan[: plan.index("Window [lag")]
    assert above.count("Exchange hashpartitioning(hospital_id") == 0
    assert fact.columns


def test_dedup_limits_rows_before_the_shuffle(spark):
    t = Tables(spark, FOLDER)
    plan = plan_of(keep_latest(t.lineitem, ["l_orderkey"], "l_shipdate"))
    assert re.search(r"Exchange hashpartitioning\(l_orderkey.*\n.*WindowGroupLimit.*Partial", plan)


def test_filters_and_columns_reach_the_scan(spark):
    t = Tables(spark, FOLDER)
    df = t.orders.filter(F.col("o_totalprice") > 1000).select("o_orderkey")
    plan = plan_of(df)
    assert "PushedFilters: [IsNotNull(o_totalprice), GreaterThan(o_totalprice,1000.0)]" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in plan
    ranged = t.orders.select(F.col("o_orderdate").cast("date").alias("d"), "o_totalprice").filter(pushed_range("d", "1996-01-01", "1996-02-01"))
    assert ranged.count() == t.orders.filter("CAST(o_orderdate AS DATE) BETWEEN '1996-01-01' AND '1996-02-01'").count()


def test_upsert_reads_only_the_partitions_of_its_batch(spark, folder):
    days = spark.range(20).select(F.col("id"), (F.col("id") % 5).cast("string").alias("d"))
    days.write.partitionBy("d").parquet(f"{folder}/t")
    target = spark.read.schema("id long, d string").parquet(f"{folder}/t")
    source = spark.range(6).select("id", F.when(F.col("id") < 3, "1").otherwise("3").alias("d"))
    df = touched_partitions(target, source, "d")
    assert {r["d"] for r in df.collect()} == {"1", "3"} and df.count() == 8
    assert re.search(r"PartitionFilters: \[[^\]]*d#\d+ >= .*Subquery", plan_of(df))


def test_report_is_a_top_k(spark):
    assert "TakeOrderedAndProject" in plan_of(load_all()["free_capacity_report"](spark, FOLDER))
