"""Gold dimensions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardmill.functions import dates as D
from wardmill.functions.cleaning import norm_text, pad_code, round_to_integer
from wardmill.functions.keys import surrogate_key
from wardmill.functions.measures import metro_flag
from wardmill.operators.dedup import keep_latest


def _calendar_columns(d):
    return [
        d.alias("full_date"),
        D.weekday_name(d).alias("day_of_week"),
        F.weekofyear(d).alias("week_number"),
        F.month(d).alias("month"),
        F.quarter(d).alias("quarter"),
        F.year(d).alias("year"),
        D.season(d).alias("season"),
        F.lit(False).alias("is_holiday"),
        D.is_flu_season(d).alias("is_flu_season"),
        D.disease_season(d).alias("disease_season"),
        D.risk_level(d).alias("healthcare_risk_level"),
        D.week_of_month(d).alias("week_of_month"),
    ]


def dim_date(spark: SparkSession, start: str = "2020-01-01", end: str = "2030-12-31") -> DataFrame:
    """Generated calendar. ``spark.range`` has exact statistics, so joins on it broadcast by size check."""
    first = date.fromisoformat(start)
    days = (date.fromisoformat(end) - first).days + 1
    d = F.date_add(F.lit(first), F.col("id").cast("int"))
    return spark.range(max(days, 0)).select(*_calendar_columns(d))


def dim_date_of(df: DataFrame, column: str) -> DataFrame:
    """Calendar over the date range of a column, found in the same plan."""
    bounds = df.agg(F.min(column).cast("date").alias("first"), F.max(column).cast("date").alias("last"))
    days = bounds.filter("first IS NOT NULL").select(
        F.explode(F.sequence("first", "last", F.expr("interval 1 day"))).alias("d")
    )
    return days.select(*_calendar_columns(F.col("d")))


def dim_geography(staged: DataFrame, as_of: str | None = None) -> DataFrame:
    """Gated silver counties with defaults; upserted by county into the target by the caller."""
    c = F.col
    columns = [
        F.trim("county_fips").alias("county_fips"),
        F.trim("county_name").alias("county_name"),
        norm_text(c("state_code")).alias("state_code"),
        F.trim("state_name").alias("state_name"),
        F.coalesce(F.trim("hrr_region"), F.lit("Unknown")).alias("hrr_region"),
        F.coalesce(c("area_km2"), F.lit(0.0)).alias("area_km2"),
        F.lit(True).alias("is_active"),
    ]
    if as_of is not None:
        columns.append(F.lit(as_of).cast("timestamp").alias("ingestion_timestamp"))
    return staged.select(*columns)


def dim_hospital(external: DataFrame, newest: str = "source_file_path") -> DataFrame:
    """One row per facility: the one from the newest file."""
    c = F.col
    rows = keep_latest(external, ["hospital_id"], newest)
    return rows.select(
        surrogate_key(c("hospital_id")).alias("hospital_sk"),
        c("hospital_id").cast("string").alias("hospital_id"),
        F.trim("hospital_name").alias("hospital_name"),
        F.coalesce(F.trim("hospital_type"), F.lit("Unknown")).alias("hospital_type"),
        pad_code(c("county_fips"), 5, truncate=True).alias("county_fips"),
        c("zip_code").cast("string").alias("zip_code"),
        c("state").cast("string").alias("state"),
        F.coalesce(c("certified_bed_count").cast("bigint"), F.lit(0)).alias("certified_bed_count"),
        c("latitude").cast("double").alias("latitude"),
        c("longitude").cast("double").alias("longitude"),
    )


def dim_population(external: DataFrame, newest: str = "source_file_path") -> DataFrame:
    """One row per county and census year; unknown measures stay NULL."""
    c = F.col
    rows = keep_latest(external, ["county_fips", "census_year"], newest)
    code = c("rucc_code").cast("int")
    return rows.select(
        surrogate_key(c("county_fips"), c("census_year")).alias("population_sk"),
        F.trim("county_fips").alias("county_fips"),
        c("census_year").cast("int").alias("census_year"),
        round_to_integer(c("total_population")).alias("total_population"),
        *[
            c(n).cast("double").alias(n)
            for n in (
                "pop_65_plus_pct", "population_density", "median_household_income", "poverty_rate_pct",
                "uninsured_rate_pct", "physicians_per_100k", "nurses_per_100k",
            )
        ],
        code.alias("rucc_code"),
        "rucc_description",
        metro_flag(code).alias("metro_nonmetro_flag"),
    )
