"""Silver tables in the form that the dimensions and the weekly fact are built from."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardmill.constants import STATE_BY_FIPS
from wardmill.functions.cleaning import pad_code


def weekly_source(utilization: DataFrame) -> DataFrame:
    """Clean utilisation rows as counts of the fact: one per facility and week.

    Silver's occupancy is a percentage and stays behind; the fact computes its
    fraction from the counts.
    """
    c = F.col
    return utilization.select(
        c("provider_id").alias("hospital_id"), c("report_date").alias("collection_week"), "state",
        c("inpatient_beds_total").alias("inpatient_beds_capacity"), "inpatient_beds_used",
        c("icu_beds_staffed").alias("icu_beds_capacity"), "icu_beds_used",
        c("covid_patients").alias("covid_hospitalized_patients"),
    )


def hospital_source(facility: DataFrame) -> DataFrame:
    """Clean facility rows as input of the facility dimension; the county code is the state's with the county's."""
    c = F.col
    codes = F.create_map(*[F.lit(x) for fips, state in STATE_BY_FIPS.items() for x in (state, fips)])
    county = F.concat(F.try_element_at(codes, F.upper(F.trim("state"))), pad_code(c("fips_county_code"), 3))
    return facility.select(
        c("provider_id").alias("hospital_id"), c("facility_name").alias("hospital_name"),
        c("facility_type_code").alias("hospital_type"), c("certified_bed_count").cast("bigint").alias("certified_bed_count"),
        c("zip_code").cast("string").alias("zip_code"), "state", county.alias("county_fips"),
    )
