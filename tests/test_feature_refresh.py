from __future__ import annotations

import datetime
import glob
import os
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from wardmill.operators.halo import islands
from wardmill.plans import feature_refresh as R
from wardmill.plans.dimensions import dim_date
from wardmill.plans.features import FACILITY, GEOGRAPHY, POPULATION, facility_attributes, feature_weekly
from wardmill.sources import writers as W

FIRST = datetime.date(2021, 1, 4)
DDL = "hospital_id string, collection_week date, state string, inpatient_beds_capacity double, inpatient_occupancy_rate double"
KEYS = ["hospital_id", "collection_week"]


def week(i):
    return FIRST + datetime.timedelta(weeks=i)


def frame(spark, data):
    return spark.createDataFrame([(h, w, "AL", cap, rate) for (h, w), (cap, rate) in sorted(data.items())], DDL)


def dimensions(spark, beds=100):
    hospitals = spark.createDataFrame([(f"H{i}", f"n{i}", "1", "x", beds + i, "01001") for i in range(7)],
                                      f"hospital_id string, {', '.join(f'{n} ' + ('long' if n == 'certified_bed_count' else 'string') for n in FACILITY)}")
    population = spark.createDataFrame([("01001", 2020, *["5"] * len(POPULATION))], "county_fips string, census_year int, " + ", ".join(f"{n} string" for n in POPULATION))
    geography = spark.createDataFrame([("01001", *["g"] * len(GEOGRAPHY))], "county_fips string, " + ", ".join(f"{n} string" for n in GEOGRAPHY))
    return dim_date(spark), hospitals, population, geography


def refreshed(spark, folder, dims, day):
    return R.refresh_features(spark, f"{folder}/features", f"{folder}/fact", R.Dimensions(dims[0], facility_attributes(*dims[1:])), day)


def merged(spark, folder, batch):
    R.note_changes(spark, f"{folder}/features", batch)
    W.upsert_partitions(spark, f"{folder}/fact", batch, KEYS, "collection_week")


def check(spark, folder, dims, day):
    want = feature_weekly(spark.read.parquet(f"{folder}/fact"), *dims, end=day)
    got = spark.read.parquet(f"{folder}/features").select(*want.columns)
    assert rows(got) == rows(want) and want.count() > 0


def test_stretches():
    weeks = [f"2021-{m:02d}-01" for m in range(1, 13)]
    assert islands(weeks, {"2021-06-01": 2}) == [("2021-04-01", "2021-08-01")]
    assert islands(weeks, {"2021-02-01": 1, "2021-05-01": 1}) == [("2021-01-01", "2021-06-01")]
    assert islands(weeks, {"2021-02-01": 1, "2021-09-01": 1}) == [("2021-01-01", "2021-03-01"), ("2021-08-01", "2021-10-01")]
    assert islands(weeks, {"2021-06-15": 1}) == [("2021-06-01", "2021-07-01")]
    assert islands(weeks, {"2020-01-01": 1, "2022-01-01": 1}) == [("2020-01-01", "2021-01-01"), ("2021-12-01", "2022-01-01")]


def test_refresh_equals_rebuild(spark, folder):
    """New, corrected, withdrawn and late rows of facilities with gaps; H5 reports every fourth week, H6 begins late."""
    rnd, dims, data = random.Random(4), dimensions(spark), {}
    for h in range(7):
        for i in range(64):
            if (h != 5 or i % 4 == 0) and (h != 6 or i > 54) and rnd.random() > 0.1:
                data[f"H{h}", week(i)] = (100.0, round(rnd.random(), 3))
    day = str(week(50))
    W.overwrite_partition(frame(spark, {k: v for k, v in data.items() if k[1] <= week(50)}), f"{folder}/fact", ["collection_week"])
    assert refreshed(spark, folder, dims, day) == R.Refresh(None, None)
    check(spark, folder, dims, day)
    assert refreshed(spark, folder, dims, day) == R.Refresh((), ())
    for step, day in enumerate((week(51), week(51), week(63))):
        changed = {("H1", week(30)): (100.0, rnd.random()), ("H5", week(12 * step)): (100.0, rnd.random()), ("H2", week(5 + step)): (0.0, 0.0),
                   ("H0", week(23)): (100.0 * (step % 2), rnd.random())}
        changed |= {k: v for k, v in data.items() if week(50 + min(step, 1)) < k[1] <= day}
        merged(spark, folder, frame(spark, changed))
        done = refreshed(spark, folder, dims, str(day))
        assert done.read and done.rewritten
        check(spark, folder, dims, str(day))


def poison(folder, keep):
    """Replaces the files of all partitions outside the dates by rubbish; returns what was there."""
    kept = {}
    for name in ("fact", "features"):
        for path in glob.glob(f"{folder}/{name}/*=*/*.parquet"):
            date = path.split("=")[1][:10]
            if not keep[0] <= date <= keep[1] and date != str(week(80)):      # the newest one shows the columns
                with open(path, "rb") as f:
                    kept[path] = f.read()
                os.remove(f"{os.path.dirname(path)}/.{os.path.basename(path)}.crc")
                with open(path, "wb") as f:
                    f.write(b"rubbish")
    return kept


def test_other_partitions_are_neither_read_nor_written(spark, folder):
    dims, day = dimensions(spark), str(week(80))
    data = {(f"H{h}", week(i)): (100.0, (h * 7 + i * 3) % 10 / 10) for h in range(4) for i in range(81)}
    W.overwrite_partition(frame(spark, data), f"{folder}/fact", ["collection_week"])
    refreshed(spark, folder, dims, day)
    merged(spark, folder, frame(spark, {("H2", week(40)): (100.0, 0.35), ("H3", week(41)): (0.0, 0.0)}))
    kept = poison(folder, (str(week(40 - 14)), str(week(41 + 14))))
    assert len(kept) > 2 * 40
    done = refreshed(spark, folder, dims, day)
    assert done.read == ((str(week(26)), str(week(55))),)
    assert done.rewritten == tuple(str(week(i)) for i in range(39, 55))      # twelve rows on from a withdrawn one is a week more
    for path, data in kept.items():
        with open(path, "rb") as f:
            assert f.read() == b"rubbish"
        with open(path, "wb") as f:
            f.write(data)
    check(spark, folder, dims, day)


def test_noted_keys_outlive_a_failed_run(spark, folder, monkeypatch):
    dims, day = dimensions(spark), str(week(30))
    W.overwrite_partition(frame(spark, {("H1", week(i)): (100.0, i % 7 / 10) for i in range(31)}), f"{folder}/fact", ["collection_week"])
    refreshed(spark, folder, dims, day)
    merged(spark, folder, frame(spark, {("H1", week(12)): (100.0, 0.99)}))
    monkeypatch.setattr(R, "replace_keys", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        refreshed(spark, folder, dims, day)
    monkeypatch.undo()
    merged(spark, folder, frame(spark, {("H1", week(20)): (100.0, 0.98)}))
    refreshed(spark, folder, dims, day)
    check(spark, folder, dims, day)


def test_changed_attributes_rebuild(spark, folder):
    day = str(week(30))
    W.overwrite_partition(frame(spark, {("H1", week(i)): (100.0, i % 7 / 10) for i in range(31)}), f"{folder}/fact", ["collection_week"])
    refreshed(spark, folder, dimensions(spark), day)
    other = dimensions(spark, beds=500)
    assert refreshed(spark, folder, other, day) == R.Refresh(None, None)
    check(spark, folder, other, day)
    assert refreshed(spark, folder, other, day) == R.Refresh((), ())


def test_a_write_that_fails_leaves_the_old_table(spark, folder):
    for write in (W.write_table, W.land):
        path = f"{folder}/{write.__name__}"
        write(spark.range(5), path)
        with pytest.raises(Exception, match="stop"):
            write(spark.range(9).withColumn("id", F.when(F.col("id") < 8, F.col("id")).otherwise(F.raise_error(F.lit("stop")).cast("bigint"))), path)
        assert spark.read.parquet(path).count() == 5
    W.write_table(spark.read.parquet(path).selectExpr("id + 1 AS id"), path)      # from itself
    assert rows(spark.read.parquet(path)) == [(i,) for i in range(1, 6)]


def test_replaced_keys(spark, folder):
    """Only the named partitions change; one without rows left goes."""
    ddl = "k int, v int, d date"
    days = [datetime.date(2024, 1, i) for i in (1, 2, 3)]
    W.overwrite_partition(spark.createDataFrame([(1, 1, days[0]), (2, 1, days[0]), (1, 1, days[1]), (5, 5, days[2])], ddl), f"{folder}/t", ["d"])
    keys = spark.createDataFrame([(1, days[0]), (1, days[1]), (9, days[0])], "k int, d date")
    new = spark.createDataFrame([(9, 9, days[0])], ddl)
    assert W.replace_keys(spark, f"{folder}/t", keys, new, "d") == [str(d) for d in days[:2]]
    assert rows(spark.read.schema(ddl).parquet(f"{folder}/t"), "k") == [(2, 1, days[0]), (5, 5, days[2]), (9, 9, days[0])]
    assert not os.path.exists(f"{folder}/t/d=2024-01-02")
    assert W.replace_keys(spark, f"{folder}/t", keys.limit(0), new, "d") == []
