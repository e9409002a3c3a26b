"""Bronze to silver: typed, deduplicated, gated."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardmill.constants import AGE_65_PLUS
from wardmill.functions.cleaning import (
    clean_numeric,
    col_or_null,
    compose_code,
    null_text,
    strip_suffix,
    to_double,
    to_integer,
    with_norm_text,
)
from wardmill.functions.measures import occupancy_pct, pct_of, per_100k, ratio, sum_columns
from wardmill.operators.dedup import keep_first
from wardmill.operators.quality import geography_gate, population_gate
from wardmill.operators.shape import keep_existing, rename_existing

# --- fixed values: source column -> silver column ---------------------------------
FACILITY_COLUMNS = {
    "PRVDR_NUM": "provider_id",
    "FAC_NM": "facility_name",
    "CITY": "city",
    "STATE_CD": "state",
    "ZIP_CD": "zip_code",
    "FIPS_CNTY_CD": "fips_county_code",
    "CRTFD_BED_CNT": "certified_bed_count",
    "FAC_TYPE_CD": "facility_type_code",
}
UTILIZATION_COLUMNS = {
    "hospital_pk": "provider_id",
    "hospital_name": "facility_name",
    "fips_code": "fips_county_code",
    "collection_week": "report_date",
    "total_beds_7_day_avg": "inpatient_beds_total",
    "inpatient_beds_used_7_day_avg": "inpatient_beds_used",
    "total_staffed_adult_icu_beds_7_day_avg": "icu_beds_staffed",
    "icu_beds_used_7_day_avg": "icu_beds_used",
    "total_adult_patients_hospitalized_confirmed_and_suspected_covid_7_day_avg": "covid_patients",
}
UTILIZATION_NUMBERS = (
    "inpatient_beds_total", "inpatient_beds_used", "icu_beds_staffed", "icu_beds_used", "covid_patients",
)
# --- fixed values: vintage columns, newest first; a tuple is summed ----------------
PHYSICIAN_COLUMNS = (
    "phys_nf_prim_care_pc_exc_rsdt_22", "stgh_fte_phys_dent_incl_nh_21",
    "f1130820", "f1130819", "f1130818",
)
NURSE_COLUMNS = (
    "aprn_npi_24", "aprn_npi_23", ("stgh_rn_ft_incl_nh_21", "aprn_npi_22"), "f1464621", "f1464620", "f1464619",
)
AUDIT = ("_source_file", "_ingested_at", "_processed_at")


def _texts_to_null(df: DataFrame) -> DataFrame:
    texts = [n for n, t in df.dtypes if t == "string"]
    return df.withColumns({n: null_text(F.col(n)) for n in texts}) if texts else df


def _one_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per complete key; rows with an unreadable key are all kept, for the rules to find."""
    incomplete = reduce(or_, [F.col(k).isNull() for k in keys])
    alone = df.withColumn("_alone", F.when(incomplete, F.monotonically_increasing_id()))
    return keep_first(alone, [*keys, "_alone"], order).drop("_alone")


def silver_facility(df: DataFrame, as_of: str | None = None, order: Sequence[Column] = ()) -> DataFrame:
    """One row per provider; ``order`` decides which (newest first), then the row's content."""
    df = _texts_to_null(rename_existing(df, FACILITY_COLUMNS))
    if "certified_bed_count" in df.columns:
        df = df.withColumn("certified_bed_count", to_integer(F.col("certified_bed_count")).cast("int"))
    df = with_norm_text(df, ["facility_name", "city", "state"])
    if as_of is not None:
        df = df.withColumn("_processed_at", F.lit(as_of).cast("timestamp"))
    return keep_existing(_one_per_key(df, ["provider_id"], order), [*FACILITY_COLUMNS.values(), *AUDIT])


def silver_utilization(df: DataFrame, as_of: str | None = None, order: Sequence[Column] = ()) -> DataFrame:
    """One row per provider and report date, occupancy in percent."""
    df = _texts_to_null(rename_existing(df, UTILIZATION_COLUMNS))
    typed = {n: to_double(F.col(n)) for n in UTILIZATION_NUMBERS if n in df.columns}
    if "report_date" in df.columns:
        typed["report_date"] = F.col("report_date").cast("string").try_cast("date")
    df = with_norm_text(df.withColumns(typed), ["facility_name", "state"])
    derived: dict[str, Column] = {}
    if {"inpatient_beds_used", "inpatient_beds_total"} <= set(df.columns):
        derived["occupancy_rate"] = occupancy_pct(F.col("inpatient_beds_used"), F.col("inpatient_beds_total"))
    if "inpatient_beds_used" in df.columns:
        derived["total_patients"] = F.col("inpatient_beds_used")
    if as_of is not None:
        derived["_processed_at"] = F.lit(as_of).cast("timestamp")
    df = df.withColumns(derived) if derived else df
    columns = [
        "provider_id", "facility_name", "state", "fips_county_code", "report_date", "inpatient_beds_total",
        "inpatient_beds_used", "icu_beds_staffed", "icu_beds_used", "occupancy_rate", "covid_patients",
        "total_patients", *AUDIT,
    ]
    return keep_existing(_one_per_key(df, ["provider_id", "report_date"], order), columns)


def silver_geography(names: DataFrame, area: DataFrame, region: DataFrame, as_of: str | None = None) -> DataFrame:
    """Counties with area and region; names are the ground truth. Gate columns included.

    The side tables are unique per county, so the joins add no rows. No
    broadcast is asked for: the optimizer takes one where the measured size
    allows it and a shuffle join otherwise.
    """
    joined = (
        names.withColumn("county_name", strip_suffix(F.col("county_name")))
        .join(area.select("county_fips", "area_km2"), ["county_fips"], "left")
        .join(region.select("county_fips", "hrr_region"), ["county_fips"], "left")
    )
    columns = [
        F.col(n).cast("string").alias(n)
        for n in ("county_fips", "county_name", "state_code", "state_name", "hrr_region")
    ] + [F.col("area_km2").cast("double").alias("area_km2")]
    if as_of is not None:
        columns.append(F.lit(as_of).cast("timestamp").alias("ingestion_timestamp"))
    return geography_gate(joined.select(*columns))


def census_measures(df: DataFrame) -> DataFrame:
    """Rates of one census row per county and year; a zero universe gives NULL."""
    c = F.col
    bands = [c(n) for n in (f"age_raw_{v}" for v in AGE_65_PLUS) if n in df.columns]
    older = sum_columns(bands) if bands else F.lit(None).cast("double")
    uninsured = c("uninsured_19_64_raw") + c("uninsured_65_plus_raw")
    return df.select(
        c("county_fips").cast("string").alias("county_fips"),
        c("census_year").cast("int").alias("census_year"),
        c("total_population_raw").cast("bigint").alias("total_population"),
        pct_of(older, c("total_population_raw")).alias("pop_65_plus_pct"),
        c("median_household_income_raw").cast("double").alias("median_household_income"),
        pct_of(c("pop_below_poverty_raw"), c("poverty_universe_raw")).alias("poverty_rate_pct"),
        pct_of(uninsured, c("insurance_universe_raw")).alias("uninsured_rate_pct"),
    )


def first_available(df: DataFrame, candidates: Sequence[str | Sequence[str]]) -> Column:
    """First vintage column that holds a number; a group of columns is summed."""
    return F.coalesce(*[
        clean_numeric(df, n) if isinstance(n, str) else sum_columns([clean_numeric(df, part) for part in n])
        for n in candidates
    ])


def workforce(
    df: DataFrame, physicians: Sequence[str | Sequence[str]] = PHYSICIAN_COLUMNS,
    nurses: Sequence[str | Sequence[str]] = NURSE_COLUMNS,
) -> DataFrame:
    """Physicians and nurses per county and year out of differently named vintage columns."""
    code = compose_code(
        (col_or_null(df, "f00011"), col_or_null(df, "f00012")),
        (col_or_null(df, "fips_st"), col_or_null(df, "fips_cnty")),
    )
    rows = df.select(
        code.alias("county_fips"),
        F.col("data_year").cast("int").alias("census_year"),
        first_available(df, physicians).alias("physicians_raw"),
        first_available(df, nurses).alias("nurses_raw"),
    )
    return keep_first(rows, ["county_fips", "census_year"])


def silver_population(
    census: DataFrame, resources: DataFrame, rural: DataFrame, geography: DataFrame, as_of: str | None = None,
    spec: Mapping[str, Sequence[str | Sequence[str]]] | None = None,
) -> DataFrame:
    """County-year measures with density, workforce rates and rural code. Gate columns included.

    ``county_fips`` joins are one row per county on the right. County tables are
    small in practice, but that is left to the optimizer's size check.
    """
    spec = spec or {}
    staff = workforce(resources, spec.get("physicians", PHYSICIAN_COLUMNS), spec.get("nurses", NURSE_COLUMNS))
    codes = keep_first(
        rural.select(
            F.col("county_fips").cast("string").alias("county_fips"),
            F.col("rucc_code_raw").cast("int").alias("rucc_code"),
            "rucc_description",
        ),
        ["county_fips"],
    )
    joined = (
        census_measures(census)
        .join(staff, ["county_fips", "census_year"], "left")
        .join(codes, ["county_fips"], "left")
        .join(geography.select("county_fips", "area_km2"), ["county_fips"], "left")
    )
    c = F.col
    people = c("total_population")
    columns = [
        "county_fips", "census_year", "total_population", "pop_65_plus_pct",
        ratio(people, c("area_km2"), 4).alias("population_density"),
        "median_household_income", "poverty_rate_pct", "uninsured_rate_pct",
        per_100k(c("physicians_raw"), people).alias("physicians_per_100k"),
        per_100k(c("nurses_raw"), people).alias("nurses_per_100k"),
        "rucc_code", "rucc_description",
    ]
    if as_of is not None:
        columns.append(F.lit(as_of).cast("timestamp").alias("ingestion_timestamp"))
    return population_gate(joined.select(*columns))
