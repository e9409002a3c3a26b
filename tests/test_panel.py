from __future__ import annotations

import datetime

from conftest import rows
from pyspark.sql import functions as F

from wardmill.operators import incremental as I
from wardmill.operators import panel as P
from wardmill.operators.dedup import keep_first, keep_latest, latest_only, pick_champion
from wardmill.plans.dimensions import dim_date
from wardmill.plans.features import FEATURE_COLUMNS, feature_weekly

START = datetime.date(2021, 1, 4)


def week(i):
    return START + datetime.timedelta(weeks=i)


def fact(spark, series):
    """{facility: [(week number, capacity, used)]}"""
    data = [(h, week(i), "CA", cap, used) for h, items in series.items() for i, cap, used in items]
    df = spark.createDataFrame(
        data, "hospital_id string, collection_week date, state string, inpatient_beds_capacity double, "
              "inpatient_beds_used double"
    )
    return df.withColumns({
        "inpatient_occupancy_rate": F.try_divide("inpatient_beds_used", "inpatient_beds_capacity"),
        "is_corrected": F.lit(None).cast("boolean"),
    })


def dims(spark):
    hospitals = spark.createDataFrame(
        [("A", "Alpha", "00001", "01001", "Acute", None), ("A", "Alpha", "00001", "01001", "Acute", None)],
        "hospital_id string, hospital_name string, zip_code string, county_fips string, hospital_type string, "
        "certified_bed_count long",
    )
    columns = ("total_population long, pop_65_plus_pct double, population_density double, median_household_income double, "
               "poverty_rate_pct double, uninsured_rate_pct double, physicians_per_100k double, nurses_per_100k double, "
               "rucc_code int, metro_nonmetro_flag string")
    population = spark.createDataFrame(
        [("01001", y, n, *[1.0] * 7, 1, "Metro") for y, n in ((2020, 5), (2021, 6))],
        f"county_fips string, census_year int, {columns}",
    )
    geography = spark.createDataFrame(
        [("01001", "Autauga", "AL-X", 9.0)], "county_fips string, county_name string, hrr_region string, area_km2 double"
    )
    return dim_date(spark), hospitals, population, geography


def features(spark, series, **kw):
    return feature_weekly(fact(spark, series), *dims(spark), **kw)


def test_feature_rows(spark):
    series = {
        "A": [(i, 100.0, float(50 + i)) for i in range(14)],
        "B": [(i, 100.0, 90.0) for i in range(3)],              # too short
        "C": [(0, 100.0, 0.0), (1, 100.0, 10.0), (2, 0.0, 5.0), *[(i, 100.0, 10.0) for i in range(3, 8)]],
        "D": [(-60, 100.0, 90.0)],                              # before the date range
    }
    df = features(spark, series, as_of="2021-06-01")
    assert tuple(df.columns) == (*FEATURE_COLUMNS, "feature_computed_at") and len(df.columns) == 72 - 1
    got = {(r["hospital_id"], r["report_date"]): r for r in df.collect()}
    a = sorted(k[1] for k in got if k[0] == "A")
    assert a == [week(i) for i in range(4, 13)]
    last = got["A", week(12)]
    assert (last["occ_lag1"], last["occ_lag12"], last["target_occupancy_next_week"]) == (0.61, 0.5, 0.63)
    assert abs(last["occ_roll4"] - 0.605) < 1e-12 and abs(last["occ_roll8"] - 0.585) < 1e-12
    assert (last["target_high_strain"], last["certified_bed_count"], last["total_population"]) == (0, 0, 6)
    assert (last["county_name"], last["is_corrected"], last["icu_lag1"]) == ("Autauga", 0, 0.0)
    assert not [k for k in got if k[0] in "BD"]
    c = sorted(k[1] for k in got if k[0] == "C")
    assert c == [week(i) for i in (5, 6)]                       # the zero-capacity week is no row
    assert got["C", week(5)]["hospital_name"] is None           # unmatched facility stays


def test_change_is_null_after_zero(spark):
    w = P.panel_window("h", "d")
    df = spark.createDataFrame([("x", i, v) for i, v in enumerate([0.0, 2.0, 3.0])], "h string, d int, v double")
    got = P.add_change(df, "v", "ch", w)
    assert rows(got.select("d", "ch"), "d") == [(0, None), (1, None), (2, 0.5)]


def test_strict_calendar(spark):
    series = {"A": [(i, 100.0, 50.0 + i) for i in (0, 1, 2, 3, 5, 6, 7, 8, 9)]}
    loose = {r["report_date"]: r["occ_lag4"] for r in features(spark, series).collect()}
    strict = {r["report_date"]: r["occ_lag4"] for r in features(spark, series, strict_calendar=True).collect()}
    assert loose[week(5)] == 0.5 and strict[week(5)] == 0.51
    assert week(8) in loose and week(8) not in strict           # four weeks back is the missing week
    assert week(4) not in strict and week(4) not in loose


def test_lag_of_lead_is_the_row_and_rolling_one_is_the_value(spark):
    w = P.panel_window("h", "d")
    df = spark.range(200).select((F.col("id") % 7).alias("h"), "id", F.col("id").alias("d"), F.rand(3).alias("v"))
    lead = P.add_next(df, "v", "nxt", w)
    back = P.add_lags(lead, {"nxt": [(1, "back")]}, w)
    assert back.filter("back IS NOT NULL AND back <> v").count() == 0
    assert P.add_rolling(df, {"v": [(1, "r")]}, w).filter("r <> v").count() == 0


def test_overload_runs(spark):
    rates = [0.9, 0.9, 0.9, 0.5, 0.9, 0.85, 0.81, 0.9, None, 0.9]
    df = spark.createDataFrame([("x", i, r) for i, r in enumerate(rates)], "h string, d int, r double")
    assert rows(P.persistent_overload(df, "h", "d", "r")) == [("x", 4, 7, 4, 0.9)]
    assert P.persistent_overload(df, "h", "d", "r", min_weeks=3).count() == 2


def test_dedup_is_independent_of_partitioning(spark):
    df = spark.createDataFrame([(1, "b", 2.0), (1, "b", None), (1, "a", 9.0), (2, None, 1.0)], "k int, o string, v double")
    for n in (1, 3, 7):
        assert rows(keep_latest(df.repartition(n), ["k"], "o")) == [(1, "b", 2.0), (2, None, 1.0)]
    assert rows(keep_first(df, ["k"], [F.col("o").asc_nulls_last()])) == [(1, "a", 9.0), (2, None, 1.0)]
    assert latest_only(df, "o").count() == 2 and latest_only(df.filter("k > 5"), "o").count() == 0


def test_champion_ties_go_to_the_preferred_model(spark):
    df = spark.createDataFrame([("LightGBM", 0.05), ("XGBoost", 0.05), ("Other", 0.06)], "model_name string, mae double")
    got = {r["model_name"]: r["status"] for r in pick_champion(df, "XGBoost").collect()}
    assert got == {"XGBoost": "production", "LightGBM": "candidate", "Other": "candidate"}


def test_incremental_forms(spark):
    ddl = "k string, d date, v int"
    day = lambda i: datetime.date(2024, 1, i)
    target = spark.createDataFrame([("a", day(1), 1), ("b", day(9), 1)], ddl)
    source = spark.createDataFrame([("a", day(1), 2), ("c", day(9), 2), ("d", day(7), 2)], ddl)
    once = I.merge_upsert(target, source, ["k", "d"])
    assert rows(once) == [("a", day(1), 2), ("b", day(9), 1), ("c", day(9), 2), ("d", day(7), 2)]
    assert rows(I.merge_upsert(once, source, ["k", "d"])) == rows(once)
    late = I.merge_upsert(target, source, ["k", "d"], since="2024-01-05", on="d")
    assert rows(late) == [("a", day(1), 1), ("a", day(1), 2), ("b", day(9), 1), ("c", day(9), 2), ("d", day(7), 2)]
    empty = target.filter("v > 5")
    assert I.append_since(empty, source, "d").count() == 3 and I.append_since(target, source, "d").count() == 2
    assert rows(I.late_window(target, source, "d", 3)) == [("c", day(9), 2), ("d", day(7), 2)]
    assert I.late_window(empty, source, "d", 3).count() == 3
    replaced = I.replace_run(target, source.filter("k = 'c'"), "d", "2024-01-09")
    assert rows(replaced) == [("a", day(1), 1), ("c", day(9), 2)]
    assert rows(I.replace_run(replaced, source.filter("k = 'c'"), "d", "2024-01-09")) == rows(replaced)


def test_guards(spark):
    ddl = "report_date date, run_date date"
    day = lambda i: datetime.date(2024, 1, i)
    feats = spark.createDataFrame([(day(8), None), (day(20), None)], ddl)
    done = spark.createDataFrame([(day(8), day(10)), (day(8), day(15))], ddl)
    check = lambda f, d, as_of: I.has_new_data(f, d, as_of).first()["has_new_data"]
    assert check(feats, done, "2024-01-15") is False
    assert check(feats, done, "2024-01-10") is True          # the run itself does not count
    assert check(feats, done, "2024-01-21") is True
    assert check(feats, done, "2024-01-01") is False
    fresh = lambda as_of: tuple(I.freshness(feats, "report_date", as_of).first())
    assert fresh("2024-01-30") == (1, 1) and fresh("2024-05-01") == (1, 0) and fresh("2024-01-01") == (0, 0)


def test_calendar(spark):
    d = {r["full_date"].isoformat(): r for r in dim_date(spark).collect()}
    assert len(d) == 4018
    assert (d["2021-01-01"]["week_number"], d["2021-01-01"]["day_of_week"]) == (53, "Friday")
    assert d["2024-12-15"]["season"] == "Winter" and d["2024-12-15"]["week_of_month"] == 3
    assert d["2024-06-01"]["disease_season"] == "Off" and d["2024-02-01"]["healthcare_risk_level"] == "High"
