"""The standard reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardmill.checks import views as V
from wardmill.checks.panels import PERSISTENT_SQL
from wardmill.checks.registry import Tables, check
from wardmill.checks.views import oracle
from wardmill.plans import reports as R
from wardmill.plans.serving import forecast_serving

c = F.col

STATUS = """CASE WHEN inpatient_occupancy_rate >= CAST(0.9 AS DOUBLE) THEN 'CRITICAL'
    WHEN inpatient_occupancy_rate >= CAST(0.7 AS DOUBLE) THEN 'WARNING' ELSE 'NORMAL' END AS status"""
CURRENT = "collection_week = (SELECT MAX(collection_week) FROM v_fact)"
PCTS = """round(predicted_occupancy_rate * 100, 1) AS predicted_pct, round(confidence_lower_95 * 100, 1) AS conf_lower_pct,
  round(confidence_upper_95 * 100, 1) AS conf_upper_pct"""


def _forecast(t: Tables) -> DataFrame:
    return forecast_serving(V.predictions(t), V.hospitals(t))


@check("R01 F07 J08 D16 S02", oracle(f"""
SELECT f.hospital_id, hospital_name, f.state, round(inpatient_occupancy_rate * 100, 1) AS occupancy_pct,
  inpatient_beds_used, inpatient_beds_capacity, collection_week, {STATUS}
FROM v_fact f JOIN v_hospitals d ON f.hospital_id = d.hospital_id
WHERE {CURRENT} AND inpatient_occupancy_rate > CAST(0.9 AS DOUBLE)
ORDER BY inpatient_occupancy_rate DESC, f.hospital_id LIMIT 100
""", "v_fact", "v_hospitals"))
def over_capacity_report(t: Tables) -> DataFrame:
    return R.report_over_capacity(V.fact(t), V.hospitals(t))


@check("R02 F07 S02", oracle(f"""
SELECT forecast_id, hospital_name, state, {PCTS}, forecast_date, run_date FROM v_forecast
WHERE run_date = (SELECT MAX(run_date) FROM v_forecast) AND alert_flag
ORDER BY predicted_occupancy_rate DESC, forecast_id LIMIT 100
""", "v_forecast"))
def at_risk_report(t: Tables) -> DataFrame:
    return R.report_at_risk(_forecast(t))


@check("R03 F07 F08 S02", oracle(f"""
SELECT forecast_id, hospital_name, state, {PCTS}, shap_feature_1, round(shap_value_1, 4) AS shap_value_1, shap_feature_2,
  round(shap_value_2, 4) AS shap_value_2, shap_feature_3, round(shap_value_3, 4) AS shap_value_3, forecast_date, run_date,
  model_version
FROM v_forecast WHERE run_date = (SELECT MAX(run_date) FROM v_forecast) AND lower(hospital_name) LIKE lower('%SUPPLIER#%')
ORDER BY predicted_occupancy_rate DESC, forecast_id LIMIT 10
""", "v_forecast"))
def alert_driver_report(t: Tables) -> DataFrame:
    return R.report_alert_drivers(_forecast(t), "SUPPLIER#")


@check("R04 F07 J08 D09 D16 S02", oracle(f"""
SELECT f.hospital_id, hospital_name, f.state, county_name, inpatient_beds_capacity - inpatient_beds_used AS available_beds,
  icu_beds_capacity - icu_beds_used AS available_icu_beds, round(inpatient_occupancy_rate * 100, 1) AS occupancy_pct,
  inpatient_beds_capacity, inpatient_beds_used, {STATUS}, collection_week
FROM v_fact f JOIN v_hospitals d ON f.hospital_id = d.hospital_id JOIN v_geography g ON d.county_fips = g.county_fips
WHERE {CURRENT} AND inpatient_occupancy_rate < CAST(0.7 AS DOUBLE)
ORDER BY available_beds DESC, f.hospital_id LIMIT 100
""", "v_fact", "v_hospitals", "v_geography"))
def free_capacity_report(t: Tables) -> DataFrame:
    return R.report_available(V.fact(t), V.hospitals(t), V.geography(t))


TREND_SQL = """
SELECT hospital_id, state, CAST(collection_week - CAST(dayofweek(collection_week) AS INTEGER) AS DATE) AS week_start,
  round(AVG(inpatient_occupancy_rate) * 100, 1) AS avg_occupancy_pct,
  round(AVG(icu_occupancy_rate) * 100, 1) AS avg_icu_occupancy_pct, SUM(inpatient_beds_used) AS total_beds_in_use,
  SUM(covid_admissions_adult + covid_admissions_pediatric) AS total_admissions
FROM v_fact WHERE collection_week BETWEEN DATE '2001-06-30' - 28 AND DATE '2001-06-30' GROUP BY 1, 2, 3
"""


@check("A08 X11", oracle(TREND_SQL, "v_fact"))
def weekly_trends(t: Tables) -> DataFrame:
    return R.weekly_trend(V.fact(t), V.AS_OF)


@check("R05 F06 J08 A08 S02", oracle(f"""
SELECT tr.*, hospital_name FROM ({TREND_SQL}) tr JOIN v_hospitals d ON tr.hospital_id = d.hospital_id

""", "v_fact", "v_hospitals"))
def trend_report(t: Tables) -> DataFrame:
    return R.report_trend(V.fact(t), V.hospitals(t), V.AS_OF)


def _rank_sql(scope: str) -> str:
    return f"""
SELECT f.hospital_id, hospital_name, f.state, hrr_region, county_name, round(inpatient_occupancy_rate * 100, 1) AS occupancy_pct,
  inpatient_beds_capacity - inpatient_beds_used AS available_beds, inpatient_beds_capacity, {STATUS}, collection_week,
  rank() OVER (PARTITION BY {scope} ORDER BY inpatient_occupancy_rate DESC) AS rank_in_scope
FROM v_fact f JOIN v_hospitals d ON f.hospital_id = d.hospital_id JOIN v_geography g ON d.county_fips = g.county_fips
WHERE {CURRENT}
"""


@check("R06 W10 F07 J08 S02", oracle(
    _rank_sql("hrr_region"),
    "v_fact", "v_hospitals", "v_geography",
))
def region_rank_report(t: Tables) -> DataFrame:
    return R.report_region_rank(V.fact(t), V.hospitals(t), V.geography(t))


@check("R06 W10", oracle(_rank_sql("county_name"), "v_fact", "v_hospitals", "v_geography"))
def county_ranks(t: Tables) -> DataFrame:
    return R.region_rank(V.fact(t), V.hospitals(t), V.geography(t), "county_name")


@check("R07", oracle(f"""
SELECT forecast_id, hospital_id, hospital_name, state, forecast_date, run_date, alert_flag, {PCTS} FROM v_forecast
WHERE run_date = (SELECT MAX(run_date) FROM v_forecast) AND forecast_date BETWEEN DATE '2024-01-30' AND DATE '2024-01-30' + 7
""", "v_forecast"))
def forecast_window_report(t: Tables) -> DataFrame:
    return R.report_forecast_window(_forecast(t), "2024-01-30")


@check("R08 W11", oracle(f"""
SELECT p.hospital_id, hospital_name, run_start, run_end, n_weeks, round(peak_rate * 100, 1) AS peak_pct
FROM ({PERSISTENT_SQL}) p JOIN v_hospitals d ON p.hospital_id = d.hospital_id
""", "v_fact", "v_hospitals"))
def persistent_overload_report(t: Tables) -> DataFrame:
    return R.report_persistent_overload(V.fact(t), V.hospitals(t))
