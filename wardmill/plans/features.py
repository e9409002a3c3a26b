"""The weekly feature store.

Plan shape: the panel is exchanged once, by facility. All lags, leads and
rolling means share that exchange and its sort, and the facility attributes,
already joined with their county's, are attached by the same key, so the panel
is not moved again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardmill.functions.measures import flag, high_strain
from wardmill.operators.dedup import keep_first, latest_only
from wardmill.operators.panel import (
    add_change,
    add_lags,
    add_next,
    add_rolling,
    complete_rows,
    densify_weeks,
    panel_filter,
    panel_window,
)
from wardmill.operators.shape import col_or_default

# --- fixed values: feature name -> fact column, and the window features --------------
LEVELS = {
    "inpatient_capacity": "inpatient_beds_capacity",
    "inpatient_used": "inpatient_beds_used",
    "occupancy_rate": "inpatient_occupancy_rate",
    "icu_capacity": "icu_beds_capacity",
    "icu_used": "icu_beds_used",
    "icu_occupancy_rate": "icu_occupancy_rate",
    "covid_patients": "covid_hospitalized_patients",
    "covid_icu": "covid_icu_patients",
    "flu_patients": "influenza_hospitalized_patients",
    "flu_icu": "influenza_icu_patients",
    "ed_visits": "ed_visits_total",
    "covid_admit_adult": "covid_admissions_adult",
    "covid_admit_peds": "covid_admissions_pediatric",
    "peds_capacity": "pediatric_beds_capacity",
    "peds_used": "pediatric_beds_used",
}
LAGS = {
    "occupancy_rate": [(n, f"occ_lag{n}") for n in (1, 2, 3, 4, 8, 12)],
    "icu_occupancy_rate": [(n, f"icu_lag{n}") for n in (1, 4)],
    "covid_patients": [(n, f"covid_lag{n}") for n in (1, 2, 4)],
    "flu_patients": [(n, f"flu_lag{n}") for n in (1, 4)],
    "ed_visits": [(1, "ed_lag1")],
}
ROLLING = {
    "occupancy_rate": [(4, "occ_roll4"), (8, "occ_roll8")],
    "icu_occupancy_rate": [(4, "icu_roll4")],
    "covid_patients": [(4, "covid_roll4")],
    "flu_patients": [(4, "flu_roll4")],
    "ed_visits": [(4, "ed_roll4")],
}
CHANGE = "occ_wow_pct_change"
TARGET = "target_occupancy_next_week"
LABEL = "target_high_strain"
REQUIRED = (TARGET, "occ_lag4", "occupancy_rate")
CALENDAR = ("week_number", "month", "quarter", "year", "season")
CALENDAR_FLAGS = ("is_holiday", "is_flu_season")
CALENDAR_LABELS = ("disease_season", "healthcare_risk_level", "week_of_month")
FACILITY = ("hospital_name", "zip_code", "hospital_type", "certified_bed_count", "county_fips")
POPULATION = (
    "total_population", "pop_65_plus_pct", "population_density", "median_household_income", "poverty_rate_pct",
    "uninsured_rate_pct", "physicians_per_100k", "nurses_per_100k", "rucc_code", "metro_nonmetro_flag",
)
GEOGRAPHY = ("county_name", "hrr_region", "area_km2")
WINDOW_COLUMNS = (
    *[a for items in LAGS.values() for _, a in items], *[a for items in ROLLING.values() for _, a in items], CHANGE,
)
FEATURE_COLUMNS = (
    "hospital_id", "report_date", "state", "hospital_name", "zip_code", *LEVELS, "is_corrected", *WINDOW_COLUMNS,
    *CALENDAR, *CALENDAR_FLAGS, *CALENDAR_LABELS, "hospital_type", "certified_bed_count", "county_fips",
    *POPULATION, *GEOGRAPHY, TARGET, LABEL,
)


def base_panel(fact: DataFrame, dates: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """Filtered fact with renamed, zero-filled levels and its calendar attributes."""
    kept = panel_filter(fact, "inpatient_beds_capacity", "collection_week", start, end)
    levels = kept.select(
        "hospital_id",
        F.col("collection_week").alias("report_date"),
        "state",
        *[col_or_default(kept, source, 0.0).alias(name) for name, source in LEVELS.items()],
        flag(col_or_default(kept, "is_corrected", False)).alias("is_corrected"),
    )
    calendar = dates.select(
        F.col("full_date").alias("report_date"),
        *CALENDAR,
        *[flag(F.col(n)).alias(n) for n in CALENDAR_FLAGS],
        *CALENDAR_LABELS,
    )
    return levels.join(calendar, ["report_date"], "left")


def with_history(panel: DataFrame, entity: str | Sequence[str] = "hospital_id") -> DataFrame:
    """Lags, rolling means, relative change and next-week target, all over one window."""
    w = panel_window(entity, "report_date")
    df = add_rolling(add_lags(panel, LAGS, w), ROLLING, w)
    return add_next(add_change(df, "occupancy_rate", CHANGE, w), "occupancy_rate", TARGET, w)


def facility_attributes(hospitals: DataFrame, population: DataFrame, geography: DataFrame) -> DataFrame:
    """One row per facility with the newest census of its county.

    Built from dimensions only, before the panel is touched: the county join
    moves facilities, not facility-weeks.
    """
    facility = keep_first(hospitals.select("hospital_id", *FACILITY), ["hospital_id"])
    facility = facility.withColumn("certified_bed_count", F.coalesce(F.col("certified_bed_count"), F.lit(0)))
    county = (
        latest_only(population, "census_year")
        .select("county_fips", *POPULATION)
        .join(geography.select("county_fips", *GEOGRAPHY), ["county_fips"], "left")
    )
    return facility.join(county, ["county_fips"], "left")


def feature_weekly(
    fact: DataFrame, dates: DataFrame, hospitals: DataFrame, population: DataFrame, geography: DataFrame,
    start: str | None = None, end: str | None = None, strict_calendar: bool = False, as_of: str | None = None,
) -> DataFrame:
    """Feature rows that have a target and four rows of history.

    ``strict_calendar`` fills missing weeks first, so that a lag of four means
    four weeks instead of four rows; filled weeks themselves are not emitted.
    Without ``end`` the panel goes up to ``as_of``, or to the newest week.
    """
    panel = base_panel(fact, dates, start, end or as_of)
    if strict_calendar:
        panel = densify_weeks(panel, "hospital_id", "report_date")
    return feature_rows(with_history(panel), facility_attributes(hospitals, population, geography), as_of)


def feature_rows(history: DataFrame, attributes: DataFrame, as_of: str | None = None) -> DataFrame:
    """Complete rows of the panel with its windows, labelled and joined with their facility's attributes."""
    rows = complete_rows(history, REQUIRED)
    labelled = rows.join(attributes, ["hospital_id"], "left").withColumn(LABEL, high_strain(F.col(TARGET)))
    columns = list(FEATURE_COLUMNS)
    if as_of is not None:
        labelled = labelled.withColumn("feature_computed_at", F.lit(as_of).cast("timestamp"))
        columns.append("feature_computed_at")
    return labelled.select(*columns)
