"""Bronze to silver for facilities and utilisation, or for the county tables.

    spark-submit --py-files wardmill.zip -m wardmill.jobs.silver utilization 2024-05-10 --bronze B --silver S
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from wardmill import schemas
from wardmill.constants import MAX_BAD_RATE
from wardmill.operators.quality import apply_rules, facility_rules, utilization_rules
from wardmill.plans.conform import hospital_source, weekly_source
from wardmill.plans.fact import FACT_KEYS
from wardmill.plans.params import RunParams
from wardmill.plans.silver import silver_facility, silver_geography, silver_population, silver_utilization
from wardmill.session import build_session
from wardmill.sources.readers import landed_folder, read_external, read_glob, with_lineage, with_source_path
from wardmill.sources.writers import SplitCounts, append_quality_log, quality_row, upsert_partitions, write_split, write_table


def run_utilization(spark: SparkSession, params: RunParams, bronze: str, silver: str) -> dict[str, SplitCounts]:
    day = params.run_date
    # One landed batch of each source, not their history: the merges below and the dimensions keep what earlier ones brought.
    facility, usage = (
        with_lineage(read_glob(spark, landed_folder(spark, f"{bronze}/{name}", day), "*.parquet", ddl), name, day)
        for name, ddl in (("facility", schemas.BRONZE_FACILITY), ("utilization", schemas.BRONZE_UTILIZATION))
    )
    newest = [F.col("_path").desc()]        # of several files the newest path decides, then content
    batches = {
        "facility": apply_rules(silver_facility(with_source_path(facility, "_path"), day, newest), facility_rules(day)),
        "utilization": apply_rules(silver_utilization(with_source_path(usage, "_path"), day, newest), utilization_rules(day)),
    }
    counts = {name: write_split(df, silver, name, day) for name, df in batches.items()}
    if counts["facility"].clean_rows:
        clean = spark.read.parquet(f"{silver}/facility/route=silver/exec_date={day}")
        write_table(hospital_source(clean), f"{silver}/hospital/route=silver/exec_date={day}")
    if counts["utilization"].clean_rows:
        clean = spark.read.parquet(f"{silver}/utilization/route=silver/exec_date={day}")
        upsert_partitions(spark, f"{silver}/weekly", weekly_source(clean), list(FACT_KEYS), "collection_week")
    rows = [quality_row(name, day, n) for name, n in counts.items() if n.total_rows]
    if rows:
        append_quality_log(spark, f"{silver}/quality_log", rows)
    return counts


def run_geography(spark: SparkSession, params: RunParams, bronze: str, silver: str) -> SplitCounts:
    day = params.run_date
    parts = [spark.read.parquet(f"{bronze}/geography/{n}/{day}") for n in ("names", "area", "region")]
    return write_split(silver_geography(*parts, as_of=day), silver, "geography", day)


def run_population(spark: SparkSession, params: RunParams, bronze: str, silver: str) -> SplitCounts:
    day = params.run_date
    census, resources, rural = (
        spark.read.parquet(f"{bronze}/population/{n}/{day}") for n in ("census", "resources", "rural")
    )
    geography = read_external(
        spark, f"{silver}/geography", schemas.EXT_GEOGRAPHY, ["route", "exec_date"]
    ).filter(f"route = 'silver' AND exec_date = '{day}'")
    rows = silver_population(census, resources, rural, geography, as_of=day)
    return write_split(rows, silver, "population", day, max_bad_rate=MAX_BAD_RATE)


JOBS = {"utilization": run_utilization, "geography": run_geography, "population": run_population}


def main() -> None:
    parser = argparse.ArgumentParser()
    parser.add_argument("table", choices=sorted(JOBS))
    parser.add_argument("run_date")
    parser.add_argument("--bronze", required=True)
    parser.add_argument("--silver", required=True)
    args = parser.parse_args()
    spark = build_session(f"silver-{args.table}")
    print(JOBS[args.table](spark, RunParams(args.run_date), args.bronze, args.silver))
    spark.stop()


if __name__ == "__main__":
    main()
