"""Landed raw files to typed bronze tables: parse, check the contract, write; fetching is not done here.

Malformed lines and payload rows go to ``malformed/SOURCE/DATE`` with their reason and place, in the pass that reads them.

    python -m wardmill.jobs.bronze facility 2024-05-10 --landed L --bronze B
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardmill import schemas
from wardmill.constants import AGE_65_PLUS, MAX_BAD_RATE
from wardmill.operators.shape import conform, require_columns, stack, unique_names
from wardmill.plans.bronze import (
    CENSUS_COLUMNS,
    area_pieces,
    by_catchment,
    census_year,
    county_area,
    county_names,
    county_region,
    flu_state_week,
    flu_surveillance,
    rural_codes,
    zip_regions,
)
from wardmill.plans.params import RunParams
from wardmill.session import build_session, child_names, staging_path
from wardmill.sources.checked import checked_csv_with_preamble, checked_delimited, checked_fixed_width, checked_json_matrix, checked_json_records
from wardmill.sources.readers import read_latest_vintage, read_vintages
from wardmill.sources.text_formats import read_delimited, read_layout, rows_from_json_matrix
from wardmill.sources.writers import land, land_as_strings, land_checked


def vintages(spark: SparkSession, root: str, name: str) -> list[int]:
    """Years of the landed folders ``name_YEAR``, the newest first."""
    found = sorted((int(y) for x in child_names(spark, root) for n, _, y in [x.rpartition("_")] if n == name and y.isdecimal()), reverse=True)
    if not found:
        raise FileNotFoundError(f"no vintage of {name} under {root}")
    return found


def _kept(records: DataFrame, bronze: str, source: str, day: str, max_bad_rate: float | None = MAX_BAD_RATE) -> DataFrame:
    """Good records of a checked scan, stored; the others are quarantined."""
    spark = records.sparkSession
    place = staging_path(spark, source)
    land_checked(records, place, f"{bronze}/malformed/{source}/{day}", max_bad_rate)
    return spark.read.schema(records.schema).parquet(place).select(*[n for n in records.columns if not n.startswith("_") and n != "line"])


def run_facility(spark: SparkSession, params: RunParams, landed: str, bronze: str) -> None:
    """Facilities as delimited text; all values stay text."""
    day, source = params.run_date, f"{landed}/facility/{params.run_date}"
    columns = require_columns(read_delimited(spark, source), ["PRVDR_NUM", "FAC_NM"]).columns
    rows = _kept(checked_delimited(spark, source, columns), bronze, "facility", day, None)
    land_as_strings(conform(rows, schemas.BRONZE_FACILITY), f"{bronze}/facility/{day}")


def run_utilization(spark: SparkSession, params: RunParams, landed: str, bronze: str) -> None:
    """Utilisation as JSON records, one or an array of them a line; parsed once, without a pass that infers a schema."""
    day = params.run_date
    rows = checked_json_records(spark, f"{landed}/utilization/{day}", schemas.BRONZE_UTILIZATION)
    land_checked(rows, f"{bronze}/utilization/{day}", f"{bronze}/malformed/utilization/{day}", required=["hospital_pk", "collection_week"])


def run_census(spark: SparkSession, params: RunParams, landed: str, bronze: str) -> None:
    """One payload a year, ``census/acs_YEAR``; all years that exist are stacked."""
    day, root = params.run_date, f"{landed}/census"
    names = ["state", "county", *CENSUS_COLUMNS, *AGE_65_PLUS]
    years = []
    for year in vintages(spark, root, "acs"):
        payload = spark.read.text(f"{root}/acs_{year}", wholetext=True).select("value", F.col("_metadata.file_path").alias("path"))
        years.append(census_year(_kept(checked_json_matrix(payload, "value", names, "path"), bronze, f"census_{year}", day), year))
    land(stack(years), f"{bronze}/population/census/{day}")


def run_resources(spark: SparkSession, params: RunParams, landed: str, bronze: str) -> None:
    """Health resources by vintage, ``resources/ahrf_YEAR``: fixed-width files with their layout, or delimited ones; names in lower case."""
    day, root = params.run_date, f"{landed}/resources"
    parts = []
    for year in vintages(spark, root, "ahrf"):
        folder = f"{root}/ahrf_{year}"
        if "layout" in child_names(spark, folder):
            rows = checked_fixed_width(spark, f"{folder}/data", read_layout(spark, f"{folder}/layout"), padded=False)
        else:
            rows = checked_delimited(spark, folder, read_delimited(spark, folder, encoding="ISO-8859-1").columns, encoding="ISO-8859-1")
        kept = _kept(rows, bronze, f"resources_{year}", day)
        parts.append((year, kept.toDF(*unique_names([n.lower() for n in kept.columns]))))
    land(read_vintages(parts), f"{bronze}/population/resources/{day}")


def run_flu(spark: SparkSession, params: RunParams, landed: str, bronze: str) -> None:
    """Activity by state and week, and the surveillance table, whose files begin with free text."""
    day = params.run_date
    activity = f"{landed}/flu_activity/{day}"
    rows = _kept(checked_delimited(spark, activity, read_delimited(spark, activity).columns), bronze, "flu_activity", day)
    land(flu_state_week(rows), f"{bronze}/flu/activity/{day}")
    table = checked_csv_with_preamble(spark, f"{landed}/flu_surveillance/{day}", ["CATCHMENT"], {"YEAR": ["SEASON_YEAR", "MMWR_YEAR"]})
    national, states = by_catchment(flu_surveillance(_kept(table, bronze, "flu_surveillance", day)))
    land(national, f"{bronze}/flu/national/{day}")
    land(states, f"{bronze}/flu/states/{day}")


def run_geography(spark: SparkSession, params: RunParams, landed: str, bronze: str) -> None:
    """County names, areas and regions of their newest vintages."""
    day, root = params.run_date, f"{landed}/geography"
    bodies = read_latest_vintage(spark, f"{root}/names_{{}}", vintages(spark, root, "names"), lambda p: spark.read.text(p, wholetext=True), "vintage")
    vintage = vintages(spark, root, "names")[0]
    land(county_names(rows_from_json_matrix(bodies, "value"), vintage), f"{bronze}/geography/names/{day}")
    vintage = vintages(spark, root, "area")[0]
    land(county_area(read_delimited(spark, f"{root}/area_{vintage}", "\t"), vintage), f"{bronze}/geography/area/{day}")
    vintage = vintages(spark, root, "region")[0]
    regions = zip_regions(read_delimited(spark, f"{root}/region_{vintage}"), str(vintage))
    pieces = area_pieces(read_delimited(spark, f"{root}/pieces", "|"))
    land(county_region(pieces, regions).withColumn("exec_date", F.lit(day)), f"{bronze}/geography/region/{day}")


def run_rural(spark: SparkSession, params: RunParams, landed: str, bronze: str) -> None:
    land(rural_codes(read_delimited(spark, f"{landed}/rural/{params.run_date}")), f"{bronze}/population/rural/{params.run_date}")


JOBS = {"facility": run_facility, "utilization": run_utilization, "geography": run_geography, "rural": run_rural, "census": run_census,
        "resources": run_resources, "flu": run_flu}


def main() -> None:
    parser = argparse.ArgumentParser()
    parser.add_argument("table", choices=sorted(JOBS))
    parser.add_argument("run_date")
    parser.add_argument("--landed", required=True)
    parser.add_argument("--bronze", required=True)
    args = parser.parse_args()
    spark = build_session(f"bronze-{args.table}")
    JOBS[args.table](spark, RunParams(args.run_date), args.landed, args.bronze)
    spark.stop()


if __name__ == "__main__":
    main()
