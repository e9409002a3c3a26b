from __future__ import annotations

import datetime
import glob
import json
import os

import pytest
from conftest import rows
from pyspark.sql import functions as F

from wardmill import schemas
from wardmill.operators.shape import conform
from wardmill.plans.params import RunParams
from wardmill.sources import writers as W


def files(path):
    return [p for p in glob.glob(f"{path}/**/*.parquet", recursive=True)]


def frame(spark, *data):
    return spark.createDataFrame(list(data), "k string, v int, d string")


def test_partition_overwrite_leaves_other_dates(spark, folder):
    path = f"{folder}/t"
    W.overwrite_partition(frame(spark, ("a", 1, "01"), ("b", 2, "02")), path, ["d"])
    W.overwrite_partition(frame(spark, ("c", 3, "02")), path, ["d"], ["k"])
    W.overwrite_partition(frame(spark, ("c", 3, "02")), path, ["d"], ["k"])
    assert rows(spark.read.schema("k string, v int, d string").parquet(path)) == [("a", 1, "01"), ("c", 3, "02")]


def test_small_output_is_one_file(spark, folder):
    df = spark.range(0, 1000, numPartitions=7).withColumn("d", F.lit("x"))
    W.write_table(df, f"{folder}/t", ["d"], ["id"])
    assert len(files(f"{folder}/t")) == 1


def batch(spark, n_bad):
    data = [(f"g{i}", False) for i in range(8)] + [(f"b{i}", True) for i in range(n_bad)]
    return spark.createDataFrame(data, "k string, _has_violation boolean")


def test_split_write_counts_and_rerun(spark, folder):
    counts = W.write_split(batch(spark, 2), folder, "src", "2024-01-01")
    assert (counts.total_rows, counts.clean_rows, counts.quarantine_rows, counts.quarantine_rate) == (10, 8, 2, 0.2)
    bad = spark.read.schema("k string, _quarantine_source string, _quarantine_date string, exec_date string").parquet(
        f"{folder}/src/route=quarantine"
    )
    assert rows(bad)[0] == ("b0", "src", "2024-01-01", "2024-01-01")
    W.write_split(batch(spark, 1), folder, "src", "2024-01-02")
    again = W.write_split(batch(spark, 0), folder, "src", "2024-01-01")
    assert (again.clean_rows, again.quarantine_rows) == (8, 0)
    left = spark.read.schema("route string, exec_date string").parquet(f"{folder}/src").groupBy("route", "exec_date").count()
    assert rows(left) == [("quarantine", "2024-01-02", 1), ("silver", "2024-01-01", 8), ("silver", "2024-01-02", 8)]


def test_split_write_stops_before_writing(spark, folder):
    with pytest.raises(RuntimeError):
        W.write_split(batch(spark, 3), folder, "src", "2024-01-01", max_bad_rate=0.2)
    assert not os.path.exists(f"{folder}/src")
    W.write_split(batch(spark, 2), folder, "src", "2024-01-01", max_bad_rate=0.2)


def test_quality_log_appends(spark, folder):
    row = W.quality_row("s", "2024-01-01", W.SplitCounts(10, 8, 2))
    W.append_quality_log(spark, folder + "/log", [row])
    W.append_quality_log(spark, folder + "/log", [row])
    got = spark.read.schema(schemas.QUALITY_LOG).parquet(folder + "/log")
    assert got.count() == 2 and got.first()["quarantine_rate"] == 0.2


def test_landing(spark, folder):
    df = spark.createDataFrame([(1, None), (2, 1.5)], "a int, b double")
    W.land_as_strings(df, f"{folder}/s")
    W.land(df, f"{folder}/t")
    assert rows(spark.read.parquet(f"{folder}/s")) == [("1", None), ("2", "1.5")]
    assert spark.read.parquet(f"{folder}/t").dtypes == [("a", "int"), ("b", "double")]
    assert all(".snappy." in f for f in files(f"{folder}/t"))


def test_table_and_view(spark, folder):
    name = "prediction_raw_" + os.path.basename(folder).replace("-", "_")
    for _ in range(2):
        W.ensure_table(spark, name, schemas.PREDICTION_RAW, ["run_date"], f"{folder}/raw")
    assert spark.table(name).columns[-1] == "run_date" and spark.table(name).count() == 0
    spark.sql(f"DROP TABLE {name}")
    W.publish_view(frame(spark, ("a", 1, "01")), "a_view")
    assert spark.table("a_view").count() == 1


def test_dispositions():
    assert (W.write_mode("WRITE_APPEND"), W.write_mode("WRITE_TRUNCATE")) == ("append", "overwrite")
    with pytest.raises(ValueError):
        W.write_mode("WRITE_EMPTY")


def test_run_replacement_is_idempotent_and_never_empty(spark, folder):
    path = f"{folder}/runs"
    ddl = "model string, run_date date"
    make = lambda *r: conform(spark.createDataFrame(list(r), "model string, run_date string"), ddl)
    W.write_run(make(("x", "2024-01-01"), ("y", "2024-01-08")), path)
    for _ in range(2):
        W.write_run(make(("z", "2024-01-08")), path, required=["model"])
    read = lambda: spark.read.schema(ddl).parquet(path)
    assert [r[0] for r in rows(read())] == ["x", "z"]
    with pytest.raises(ValueError):
        W.write_run(make(), path)
    with pytest.raises(ValueError, match="model"):
        W.write_run(make((None, "2024-01-08")), path, required=["model"])
    assert [r[0] for r in rows(read())] == ["x", "z"]
    W.write_run(make(("t", "2024-01-15")), path, disposition="WRITE_TRUNCATE")
    assert [r[0] for r in rows(read())] == ["t"]


def test_upsert_rewrites_only_touched_partitions(spark, folder):
    path = f"{folder}/fact"
    W.upsert_partitions(spark, path, frame(spark, ("a", 1, "01"), ("b", 1, "01"), ("a", 1, "02")), ["k", "d"], "d")
    untouched = set(files(f"{path}/d=02"))
    source = frame(spark, ("b", 9, "01"), ("c", 9, "03"))
    for _ in range(2):
        W.upsert_partitions(spark, path, source, ["k", "d"], "d")
    got = rows(spark.read.schema("k string, v int, d string").parquet(path))
    assert got == [("a", 1, "01"), ("a", 1, "02"), ("b", 9, "01"), ("c", 9, "03")]
    assert set(files(f"{path}/d=02")) == untouched
    with pytest.raises(ValueError):
        W.upsert_partitions(spark, path, source, ["k"], "d")


def test_splits_and_metadata(spark, folder):
    df = spark.createDataFrame([("a", 1.0, "train"), ("b", 2.0, "val"), ("c", 3.0, "train")], "hospital_id string, x double, split string")
    W.write_splits(df, f"{folder}/s", ["x", "absent"], ["hospital_id"])
    from wardmill.sources.readers import read_splits

    assert rows(read_splits(spark, f"{folder}/s", "train").select("hospital_id")) == [("a",), ("c",)]
    counts = W.split_counts(df)
    assert counts == {"train": 2, "val": 1, "test": 0}
    W.write_feature_metadata(spark, f"{folder}/m", ["x"], ["s"], "2022-12-31", "2023-09-30", counts)
    text = open(glob.glob(f"{folder}/m/*.json")[0]).read()
    assert json.loads(text)["feature_cols"] == ["x", "s"] and json.loads(text)["split_counts"]["train"] == 2


@pytest.mark.parametrize("bad", [
    {"run_date": "2024-1-1"}, {"run_date": "x"}, {"run_date": None}, {"lookback_days": 0}, {"lookback_days": 366},
    {"lookback_days": "40"}, {"write_disposition": "X"},
])
def test_run_parameters(bad):
    with pytest.raises(ValueError):
        RunParams(**{"run_date": "2024-01-01", **bad})
    assert RunParams("2024-01-15").days_back(14) == "2024-01-01"


def test_split_rerun_holds_exactly_the_new_batch(spark, folder):
    only = lambda *r: spark.createDataFrame(list(r), "k string, _has_violation boolean")
    left = lambda: sorted(
        (r["route"], r["k"]) for r in spark.read.schema("k string, route string, exec_date string").parquet(f"{folder}/src").collect())
    W.write_split(only(("a", False), ("b", True)), folder, "src", "2024-01-01")
    counts = W.write_split(only(("c", True), ("d", True)), folder, "src", "2024-01-01")
    assert (counts.total_rows, counts.clean_rows, counts.quarantine_rows) == (2, 0, 2)
    assert left() == [("quarantine", "c"), ("quarantine", "d")]
    W.write_split(only(("e", False)), folder, "src", "2024-01-01")
    assert left() == [("silver", "e")]
    W.write_split(only(), folder, "src", "2024-01-01")
    assert left() == [] and not [n for n in os.listdir(folder) if n.startswith("_")]


def test_failed_batch_leaves_the_run_as_it_was(spark, folder):
    path, ddl = f"{folder}/runs", "model string, run_date date"
    make = lambda *r: conform(spark.createDataFrame(list(r), "model string, run_date string"), ddl)
    assert W.write_run(make(("x", "2024-01-01"), ("y", "2024-01-01")), path) == 2
    with pytest.raises(ValueError):
        W.write_run(make((None, "2024-01-01")), path, required=["model"])
    assert [r[0] for r in rows(spark.read.schema(ddl).parquet(path))] == ["x", "y"] and os.listdir(folder) == ["runs"]


def test_append_takes_only_newer_rows(spark, folder):
    path, ddl = f"{folder}/log", "k string, run_date date"
    make = lambda *r: conform(spark.createDataFrame(list(r), "k string, run_date string"), ddl)
    assert W.append_newer(make(("a", "2024-01-01")), path, "run_date") == 1
    for expected in (1, 0):
        assert W.append_newer(make(("b", "2024-01-01"), ("c", "2024-01-02")), path, "run_date") == expected
    assert rows(spark.read.schema(ddl).parquet(path).select("k")) == [("a",), ("c",)]


def test_upsert_refuses_what_it_cannot_place(spark, folder):
    path = f"{folder}/fact"
    W.overwrite_partition(frame(spark, ("a", 1, None), ("b", 2, "01")), path, ["d"])
    for source in (frame(spark, ("c", 3, None)), frame(spark, ("c", 3, "01"), ("c", 4, "01"))):
        with pytest.raises(ValueError):
            W.upsert_partitions(spark, path, source, ["k", "d"], "d")
    W.upsert_partitions(spark, path, frame(spark, ("b", 5, "01")), ["k", "d"], "d")
    assert rows(spark.read.schema("k string, v int, d string").parquet(path)) == [("a", 1, None), ("b", 5, "01")]


def test_merged_partitions_survive_a_failed_overwrite(spark, folder, monkeypatch):
    path = f"{folder}/fact"
    W.upsert_partitions(spark, path, frame(spark, ("a", 1, "01")), ["k", "d"], "d")
    kept = []

    def fail(df, *_):
        kept.append(df.inputFiles())
        raise OSError("disk")

    monkeypatch.setattr(W, "overwrite_partition", fail)
    with pytest.raises(OSError):
        W.upsert_partitions(spark, path, frame(spark, ("b", 2, "01")), ["k", "d"], "d")
    assert rows(spark.read.parquet(*kept[0])) == [("a", 1, "01"), ("b", 2, "01")]


def test_rows_without_a_mark_stop_an_append(spark, folder):
    ddl = "k int, run_date date"
    good = spark.createDataFrame([(1, datetime.date(2024, 1, 1))], ddl)
    for path in (f"{folder}/new", f"{folder}/old"):
        if path.endswith("old"):
            W.append_newer(good, path, "run_date")
        with pytest.raises(ValueError, match="run_date"):
            W.append_newer(good.unionByName(spark.createDataFrame([(2, None)], ddl)), path, "run_date")
    assert spark.read.schema(ddl).parquet(f"{folder}/old").count() == 1
