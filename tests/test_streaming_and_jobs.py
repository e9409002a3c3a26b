from __future__ import annotations

import datetime
import glob
import os

import pytest
from conftest import rows
from pyspark.sql import functions as F

from wardmill import schemas
from wardmill.jobs import bronze, gold, silver
from wardmill.jobs.score import publish, serve, train
from wardmill.operators.quality import apply_rules, utilization_rules
from wardmill.plans.features import FEATURE_COLUMNS, GEOGRAPHY, LABEL, POPULATION, TARGET, feature_weekly
from wardmill.plans.models import BoostingParams
from wardmill.plans.params import RunParams
from wardmill.plans.silver import silver_utilization
from wardmill.streaming.arrivals import file_stream, stream_silver, stream_upsert


def usage(spark, *cases):
    return spark.createDataFrame(
        [(k, "m", "al", "069", w, "100", used, "10", "5", "8") for k, w, used in cases], schemas.BRONZE_UTILIZATION
    )


def test_stream_processes_new_files_once(spark, folder):
    source = f"{folder}/in"
    clean = lambda df: apply_rules(silver_utilization(df), utilization_rules("2030-01-01")).select(
        "provider_id", "report_date", "inpatient_beds_used", F.col("report_date").cast("string").alias("exec_date")
    )

    def run():
        stream = file_stream(spark, source, schemas.BRONZE_UTILIZATION, files_per_batch=1)
        stream_silver(stream, clean, f"{folder}/silver", f"{folder}/cp1").awaitTermination()
        stream = file_stream(spark, source, schemas.BRONZE_UTILIZATION)
        stream_upsert(
            stream, clean, f"{folder}/merged", f"{folder}/cp2", ["provider_id", "exec_date"], "exec_date"
        ).awaitTermination()

    usage(spark, ("1", "2024-01-01", "50"), ("2", "2024-01-01", "60")).coalesce(1).write.mode("append").parquet(source)
    run()
    usage(spark, ("1", "2024-01-01", "70"), ("1", "2024-01-08", "80")).coalesce(1).write.mode("append").parquet(source)
    run()
    run()
    ddl = "provider_id string, inpatient_beds_used double, exec_date string"
    every = spark.read.schema(ddl).parquet(f"{folder}/silver").drop("batch_id")
    assert rows(every) == [("1", 50.0, "2024-01-01"), ("1", 70.0, "2024-01-01"), ("1", 80.0, "2024-01-08"),
                           ("2", 60.0, "2024-01-01")]
    merged = spark.read.schema(ddl).parquet(f"{folder}/merged")
    assert rows(merged) == [("1", 70.0, "2024-01-01"), ("1", 80.0, "2024-01-08"), ("2", 60.0, "2024-01-01")]


def test_silver_to_gold(spark, folder):
    bronze, out, marts, day = f"{folder}/bronze", f"{folder}/silver", f"{folder}/gold", "2021-06-30"
    params = RunParams(day)
    usage(spark, ("1", "2021-01-01", "50"), ("2", "2021-01-01", "500")).write.parquet(f"{bronze}/utilization")
    spark.createDataFrame([("1", " a ", "x", "al", "1", "2", "nan", "01", "20210101")], schemas.BRONZE_FACILITY) \
        .write.parquet(f"{bronze}/facility")
    counts = silver.run_utilization(spark, params, bronze, out)
    assert (counts["utilization"].quarantine_rows, counts["facility"].clean_rows) == (1, 1)
    assert spark.read.schema(schemas.QUALITY_LOG).parquet(f"{out}/quality_log").count() == 2

    geo = f"{bronze}/geography"
    spark.createDataFrame([("01001", "Autauga County", "Alabama", "AL")],
                          "county_fips string, county_name string, state_name string, state_code string") \
        .write.parquet(f"{geo}/names/{day}")
    spark.createDataFrame([("01001", 10.0)], "county_fips string, area_km2 double").write.parquet(f"{geo}/area/{day}")
    spark.createDataFrame([("01001", "AL-X")], "county_fips string, hrr_region string").write.parquet(f"{geo}/region/{day}")
    assert silver.run_geography(spark, params, bronze, out).clean_rows == 1
    pop = f"{bronze}/population"
    from test_silver import census

    census(spark, ("01001", 2021, 1000.0, 5.0, 10.0, 100.0, 1.0, 2.0, 300.0)).write.parquet(f"{pop}/census/{day}")
    spark.createDataFrame([("01", "001", 2021, "5")], "f00011 string, f00012 string, data_year int, f1130819 string") \
        .write.parquet(f"{pop}/resources/{day}")
    spark.createDataFrame([("01001", 2, "Metro area")], "county_fips string, rucc_code_raw int, rucc_description string") \
        .write.parquet(f"{pop}/rural/{day}")
    assert silver.run_population(spark, params, bronze, out).clean_rows == 1

    hospital = spark.createDataFrame([("H1", "Alpha", "01001", 100, "AL")],
                                     "hospital_id string, hospital_name string, county_fips string, certified_bed_count long, state string")
    hospital.write.mode("overwrite").parquet(f"{out}/hospital/route=silver/exec_date={day}")
    first = datetime.date(2021, 4, 5)
    weeks = [("H1", first + datetime.timedelta(weeks=i), "AL", 100.0, 50.0 + i) for i in range(12)]
    spark.createDataFrame(weeks, "hospital_id string, collection_week date, state string, inpatient_beds_capacity double, "
                                 "inpatient_beds_used double").write.mode("overwrite").parquet(f"{out}/weekly")
    for i in range(2, 12):      # weekly runs, each with its trailing delta; the last one is repeated
        run_day = (first + datetime.timedelta(weeks=i)).isoformat()
        staged = gold.stage_fact(spark.read.parquet(f"{out}/weekly"), run_day)
        gold.upsert_partitions(spark, f"{marts}/fact_utilization", staged, list(gold.FACT_KEYS), "collection_week")
    for _ in range(2):
        gold.run(spark, params, out, marts)
    fact = spark.read.parquet(f"{marts}/fact_utilization")
    assert fact.count() == 11 and fact.select("hospital_id", "collection_week").distinct().count() == 11
    features = spark.read.parquet(f"{marts}/feature_weekly")
    assert features.count() == 6
    row = features.orderBy("report_date").first()
    assert (row["county_name"], row["hrr_region"], row["total_population"], row["metro_nonmetro_flag"]) == (
        "Autauga", "AL-X", 1000, "Metro")


def test_landed_files_to_fact(spark, folder):
    landed, base, out, marts = (f"{folder}/{n}" for n in ("landed", "bronze", "silver", "gold"))
    first = datetime.date(2026, 1, 5)
    days = [(first + datetime.timedelta(weeks=i)).isoformat() for i in range(8)]
    for i, day in enumerate(days):
        params = RunParams(day)
        spark.createDataFrame([("H1", "Alpha", "x", "al", "35004", "001", "100", "01", "20210101")], schemas.BRONZE_FACILITY) \
            .write.option("header", True).csv(f"{landed}/facility/{day}")
        usage(spark, ("H1", day, str(50 + i)), ("H2", "someday", "5")).write.json(f"{landed}/utilization/{day}")
        bronze.run_facility(spark, params, landed, base)
        bronze.run_utilization(spark, params, landed, base)
        counts = silver.run_utilization(spark, params, base, out)
        assert counts["utilization"].quarantine_rows == 1      # one batch a run: earlier dates' files are not read again
        for old in days[:i]:
            for name in ("facility", "utilization"):
                for path in glob.glob(f"{base}/{name}/{old}/**/*.parquet", recursive=True):
                    os.remove(path)
    weekly = spark.read.parquet(f"{out}/weekly")
    assert weekly.count() == 8 and weekly.agg(F.max("inpatient_beds_used")).first()[0] == 57.0
    hospitals = gold._routed(spark, out, "hospital", schemas.EXT_HOSPITAL, None)
    assert hospitals.select("county_fips").distinct().first()[0] == "01001"
    staged = gold.stage_fact(weekly, days[-1], 60)
    gold.upsert_partitions(spark, f"{marts}/fact_utilization", staged, list(gold.FACT_KEYS), "collection_week")
    fact = spark.read.parquet(f"{marts}/fact_utilization")
    dates = gold.dim_date(spark)
    panel_rows = feature_weekly(fact, dates, gold.dim_hospital(hospitals),
                                     spark.createDataFrame([], "county_fips string, census_year int, " + ", ".join(f"{n} string" for n in POPULATION)),
                                     spark.createDataFrame([], "county_fips string, " + ", ".join(f"{n} string" for n in GEOGRAPHY)), end=days[-1])
    assert str(panel_rows.agg(F.max("report_date")).first()[0]) == days[-2]      # the newest week with a target


def panel(spark):
    i = F.col("id")
    rate = 0.5 + 0.4 * F.sin(i % 53 / 8.0)
    base = spark.range(2400).select(
        (i % 20).cast("string").alias("hospital_id"),
        F.date_add(F.lit("2022-01-03").cast("date"), (F.floor(i / 20) * 7).cast("int")).alias("report_date"),
        rate.alias("occ_lag1"), rate.alias("occ_roll4"),
        F.when(i % 2 == 0, "Winter").otherwise("Summer").alias("season"),
        F.least(rate + 0.01, F.lit(1.0)).alias(TARGET),
    )
    return base.withColumn(LABEL, (F.col(TARGET) > 0.85).cast("int"))


def test_train_and_publish(spark, folder):
    assert set(panel(spark).columns) <= set(FEATURE_COLUMNS)
    df = panel(spark)
    df.write.parquet(f"{folder}/features")
    features = spark.read.parquet(f"{folder}/features")
    hospitals = spark.createDataFrame([(str(i), f"n{i}", "AL", "01001", 1.0, 2.0, 10 * i) for i in range(20)],
                                      "hospital_id string, hospital_name string, state string, county_fips string, "
                                      "latitude double, longitude double, certified_bed_count bigint")
    geography = spark.createDataFrame([("01001", "Autauga")], "county_fips string, county_name string")
    params = RunParams("2024-04-22")
    quick = BoostingParams(maxIter=8, maxDepth=4, stepSize=0.4, maxBins=32)
    models = train(spark, features, params, f"{folder}/out", {"XGBoost": quick, "LightGBM": quick}, "2023-06-30",
                   "2023-12-31", min_rows=100, min_training=500)
    registry = spark.read.parquet(f"{folder}/out/registry")
    assert sorted(r["status"] for r in registry.collect()) == ["candidate", "production"]
    assert spark.read.json(f"{folder}/out/evaluation").filter("gate_passed").count() == 2
    assert publish(spark, features, hospitals, models, params, f"{folder}/out") is True
    served = spark.read.parquet(f"{folder}/out/forecast")
    assert served.count() == 20 and served.filter("shap_feature_1 IS NULL OR hospital_name IS NULL").count() == 0
    assert spark.read.parquet(f"{folder}/out/observability").count() == 40
    assert publish(spark, features, hospitals, models, params, f"{folder}/out") is True      # same run again
    assert spark.read.parquet(f"{folder}/out/forecast").count() == 20
    kept = spark.read.parquet(f"{folder}/out/prediction_raw").drop("predicted_at").collect()
    assert publish(spark, features, hospitals, None, params, f"{folder}/out") is True        # stored models score alike
    assert sorted(map(str, spark.read.parquet(f"{folder}/out/prediction_raw").drop("predicted_at").collect())) == sorted(map(str, kept))
    with pytest.raises(ValueError, match="occ_roll4"):
        publish(spark, features.drop("occ_roll4"), hospitals, None, params, f"{folder}/out")
    for _ in range(2):
        serve(spark, hospitals, geography, f"{folder}/out")
        assert spark.read.parquet(f"{folder}/out/forecast_latest").count() == 20
        dashboard = spark.read.parquet(f"{folder}/out/forecast_enriched")
        assert dashboard.count() == 20 and dashboard.filter("county_name = 'Autauga'").count() == 20
    later = RunParams("2024-04-29")
    assert publish(spark, features, hospitals, models, later, f"{folder}/out") is False      # nothing new
    with pytest.raises(ValueError, match="data_not_stale"):
        publish(spark, features, hospitals, models, RunParams("2024-09-30"), f"{folder}/out")
    with pytest.raises(ValueError, match="fewer than"):
        train(spark, features, params, f"{folder}/out2", {"XGBoost": quick}, "2023-06-30", "2023-12-31",
              min_rows=10**6, min_training=1)
