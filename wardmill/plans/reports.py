"""The standard capacity reports. Rates are fractions in storage and percentages in reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardmill.constants import (
    CRITICAL_OCCUPANCY,
    FORECAST_DAYS,
    PERSISTENT_OVERLOAD,
    PERSISTENT_WEEKS,
    REPORT_ROWS,
    SEARCH_ROWS,
    TREND_DAYS,
    WARNING_OCCUPANCY,
)
from wardmill.functions.dates import sunday_week, within_days
from wardmill.functions.measures import as_pct, available, status_label
from wardmill.operators.dedup import latest_only
from wardmill.operators.ordered import rank_within
from wardmill.operators.panel import persistent_overload
from wardmill.operators.shape import name_search, top_n

_RATE = "inpatient_occupancy_rate"


def _current(fact: DataFrame) -> DataFrame:
    return latest_only(fact, "collection_week")


def _named(rows: DataFrame, hospitals: DataFrame, *extra: str) -> DataFrame:
    return rows.join(hospitals.select("hospital_id", "hospital_name", *extra), ["hospital_id"], "inner")


def _placed(rows: DataFrame, hospitals: DataFrame, geography: DataFrame) -> DataFrame:
    # Facilities meet counties first: that join moves dimension rows only.
    places = hospitals.select("hospital_id", "hospital_name", "county_fips").join(
        geography.select("county_fips", "county_name", "hrr_region"), ["county_fips"], "inner"
    )
    return rows.join(places, ["hospital_id"], "inner")


def report_over_capacity(
    fact: DataFrame, hospitals: DataFrame, state: str | None = None, threshold: float = CRITICAL_OCCUPANCY,
    n: int = REPORT_ROWS,
) -> DataFrame:
    """Facilities above the threshold in the newest week, fullest first."""
    rows = _current(fact).filter(F.col(_RATE) > threshold)
    if state is not None:
        rows = rows.filter(F.col("state") == state)
    report = _named(rows, hospitals).select(
        "hospital_id", "hospital_name", "state", as_pct(F.col(_RATE)).alias("occupancy_pct"),
        "inpatient_beds_used", "inpatient_beds_capacity", "collection_week",
        status_label(F.col(_RATE)).alias("status"), F.col(_RATE).alias("_rate"),
    )
    return top_n(report, [F.col("_rate").desc(), F.col("hospital_id")], n).drop("_rate")


def _forecast_columns() -> list:
    return [
        as_pct(F.col("predicted_occupancy_rate")).alias("predicted_pct"),
        as_pct(F.col("confidence_lower_95")).alias("conf_lower_pct"),
        as_pct(F.col("confidence_upper_95")).alias("conf_upper_pct"),
    ]


def report_at_risk(forecast: DataFrame, n: int = REPORT_ROWS) -> DataFrame:
    """Alerts of the newest run, highest prediction first."""
    rows = latest_only(forecast, "run_date").filter("alert_flag")
    ordered = top_n(rows, [F.col("predicted_occupancy_rate").desc(), F.col("forecast_id")], n)
    return ordered.select(
        "forecast_id", "hospital_name", "state", *_forecast_columns(), "forecast_date", "run_date"
    )


def report_alert_drivers(forecast: DataFrame, keyword: str, n: int = SEARCH_ROWS) -> DataFrame:
    """What drives the newest forecast of the facilities whose name matches."""
    rows = name_search(latest_only(forecast, "run_date"), "hospital_name", keyword)
    ordered = top_n(rows, [F.col("predicted_occupancy_rate").desc(), F.col("forecast_id")], n)
    drivers = [c for k in (1, 2, 3) for c in (
        F.col(f"shap_feature_{k}"), F.round(F.col(f"shap_value_{k}"), 4).alias(f"shap_value_{k}")
    )]
    return ordered.select(
        "forecast_id", "hospital_name", "state", *_forecast_columns(), *drivers, "forecast_date", "run_date",
        "model_version",
    )


def report_available(
    fact: DataFrame, hospitals: DataFrame, geography: DataFrame, below: float = WARNING_OCCUPANCY,
    n: int = REPORT_ROWS,
) -> DataFrame:
    """Free capacity of facilities below the threshold in the newest week, most beds first."""
    rows = _current(fact).filter(F.col(_RATE) < below)
    report = _placed(rows, hospitals, geography).select(
        "hospital_id", "hospital_name", "state", "county_name",
        available(F.col("inpatient_beds_capacity"), F.col("inpatient_beds_used")).alias("available_beds"),
        available(F.col("icu_beds_capacity"), F.col("icu_beds_used")).alias("available_icu_beds"),
        as_pct(F.col(_RATE)).alias("occupancy_pct"),
        "inpatient_beds_capacity", "inpatient_beds_used", status_label(F.col(_RATE)).alias("status"),
        "collection_week",
    )
    return top_n(report, [F.col("available_beds").desc(), F.col("hospital_id")], n)


def weekly_trend(fact: DataFrame, as_of: str, days: int = TREND_DAYS) -> DataFrame:
    """Per facility and Sunday week: mean rates, beds in use and admissions."""
    rows = fact.filter(within_days(F.col("collection_week"), as_of, days))
    return rows.groupBy("hospital_id", "state", sunday_week(F.col("collection_week")).alias("week_start")).agg(
        as_pct(F.avg(_RATE)).alias("avg_occupancy_pct"),
        as_pct(F.avg("icu_occupancy_rate")).alias("avg_icu_occupancy_pct"),
        F.sum("inpatient_beds_used").alias("total_beds_in_use"),
        F.sum(F.col("covid_admissions_adult") + F.col("covid_admissions_pediatric")).alias("total_admissions"),
    )


def report_trend(
    fact: DataFrame, hospitals: DataFrame, as_of: str, days: int = TREND_DAYS, n: int | None = None
) -> DataFrame:
    """Trend rows of all facilities, or on request the first ``n`` by name; aggregated before the names are joined."""
    report = _named(weekly_trend(fact, as_of, days), hospitals)
    return report if n is None else top_n(report, [F.col("hospital_name"), F.col("hospital_id"), F.col("week_start")], n)


def region_rank(fact: DataFrame, hospitals: DataFrame, geography: DataFrame, scope: str = "hrr_region") -> DataFrame:
    """Rank by occupancy inside each region (or county) in the newest week."""
    rows = _placed(_current(fact), hospitals, geography).select(
        "hospital_id", "hospital_name", "state", "hrr_region", "county_name",
        as_pct(F.col(_RATE)).alias("occupancy_pct"),
        available(F.col("inpatient_beds_capacity"), F.col("inpatient_beds_used")).alias("available_beds"),
        "inpatient_beds_capacity", status_label(F.col(_RATE)).alias("status"), "collection_week", _RATE,
    )
    return rank_within(rows, [scope], _RATE, "rank_in_scope").drop(_RATE)


def report_region_rank(
    fact: DataFrame, hospitals: DataFrame, geography: DataFrame, scope: str = "hrr_region", n: int | None = None
) -> DataFrame:
    """All facilities with their rank, or on request the first ``n`` by region and rank."""
    ranked = region_rank(fact, hospitals, geography, scope)
    return ranked if n is None else top_n(ranked, [F.col(scope), F.col("rank_in_scope"), F.col("hospital_id")], n)


def report_forecast_window(forecast: DataFrame, as_of: str, days: int = FORECAST_DAYS) -> DataFrame:
    """Newest-run forecasts for the coming days."""
    start = F.lit(as_of).cast("date")
    rows = latest_only(forecast, "run_date").filter(F.col("forecast_date").between(start, F.date_add(start, days)))
    return rows.select(
        "forecast_id", "hospital_id", "hospital_name", "state", "forecast_date", "run_date", "alert_flag",
        *_forecast_columns(),
    )


def report_persistent_overload(
    fact: DataFrame, hospitals: DataFrame, threshold: float = PERSISTENT_OVERLOAD, weeks: int = PERSISTENT_WEEKS
) -> DataFrame:
    """Facilities with long runs of high occupancy."""
    runs = persistent_overload(fact, "hospital_id", "collection_week", _RATE, threshold, weeks)
    return _named(runs, hospitals).select(
        "hospital_id", "hospital_name", "run_start", "run_end", "n_weeks", as_pct(F.col("peak_rate")).alias("peak_pct")
    )
