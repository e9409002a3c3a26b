"""Silver to gold: dimensions, the merged fact and the feature store, in dependency order."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardmill import schemas
from wardmill.constants import MERGE_DAYS, PANEL_START
from wardmill.operators.dedup import keep_latest
from wardmill.operators.incremental import merge_upsert
from wardmill.operators.quality import assert_not_null, assert_rule, assert_unique, enforce_none, utilization_assertion
from wardmill.plans.dimensions import dim_date, dim_geography, dim_hospital, dim_population
from wardmill.plans.fact import FACT_KEYS, stage_fact
from wardmill.plans.feature_refresh import Dimensions, note_changes, refresh_features
from wardmill.plans.features import facility_attributes
from wardmill.plans.params import RunParams
from wardmill.session import build_session, path_exists
from wardmill.sources.readers import read_external, with_source_path
from wardmill.sources.writers import upsert_partitions, write_table

ROUTED = ("route", "exec_date")


def _routed(spark: SparkSession, silver: str, name: str, ddl: str, day: str | None) -> DataFrame:
    rows = with_source_path(read_external(spark, f"{silver}/{name}", ddl, ROUTED)).filter("route = 'silver'")
    return rows if day is None else rows.filter(F.col("exec_date") == day)


def merge_dimension(spark: SparkSession, path: str, source: DataFrame, keys: list[str]) -> None:
    """Upsert an unpartitioned dimension; the merged table is complete before the old one goes."""
    if path_exists(spark, path):
        source = merge_upsert(spark.read.schema(source.schema).parquet(path), source, keys)
    write_table(source, path)


def run(spark: SparkSession, params: RunParams, silver: str, gold: str) -> None:
    day = params.run_date
    last = max("2030-12-31", f"{int(day[:4]) + 1}-12-31")
    write_table(dim_date(spark, end=last), f"{gold}/dim_date", cluster=["year", "month"])
    geography = dim_geography(
        keep_latest(_routed(spark, silver, "geography", schemas.EXT_GEOGRAPHY, day), ["county_fips"],
                    "source_file_path"), day
    )
    merge_dimension(spark, f"{gold}/dim_geography", geography, ["county_fips"])
    hospitals = dim_hospital(_routed(spark, silver, "hospital", schemas.EXT_HOSPITAL, None))
    write_table(hospitals, f"{gold}/dim_hospital", cluster=["county_fips", "state"])
    population = dim_population(_routed(spark, silver, "population", schemas.EXT_POPULATION, day))
    write_table(population, f"{gold}/dim_population", cluster=["county_fips"])
    features = f"{gold}/feature_weekly"
    staged = keep_latest(stage_fact(spark.read.parquet(f"{silver}/weekly"), day), list(FACT_KEYS), "dwh_updated_at")
    note_changes(spark, features, staged)
    upsert_partitions(
        spark, f"{gold}/fact_utilization", staged, list(FACT_KEYS), "collection_week",
        since=params.days_back(MERGE_DAYS), cluster=["hospital_id"],
    )
    fact = spark.read.parquet(f"{gold}/fact_utilization").filter(F.col("collection_week") >= F.lit(params.days_back(MERGE_DAYS)))
    c = F.col
    enforce_none({
        "fact keys repeated": assert_unique(fact, list(FACT_KEYS)),
        "fact keys missing": assert_not_null(fact, ["fact_id", *FACT_KEYS]),
        "fact measures impossible": assert_rule(fact, utilization_assertion(
            c("inpatient_occupancy_rate"), c("inpatient_beds_capacity"), c("inpatient_beds_used"))),
        "facilities repeated": assert_unique(hospitals, ["hospital_id"]),
        "counties repeated": assert_unique(geography, ["county_fips"]),
    })
    read = {n: spark.read.parquet(f"{gold}/{n}") for n in ("dim_date", "dim_hospital", "dim_population", "dim_geography")}
    attributes = facility_attributes(read["dim_hospital"], read["dim_population"], read["dim_geography"])
    refresh_features(spark, features, f"{gold}/fact_utilization", Dimensions(read["dim_date"], attributes), day, PANEL_START)


def main() -> None:
    parser = argparse.ArgumentParser()
    parser.add_argument("run_date")
    parser.add_argument("--silver", required=True)
    parser.add_argument("--gold", required=True)
    args = parser.parse_args()
    spark = build_session("gold")
    run(spark, RunParams(args.run_date), args.silver, args.gold)
    spark.stop()


if __name__ == "__main__":
    main()
