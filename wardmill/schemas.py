"""Table schemas, written as Spark DDL and parsed where a StructType is needed."""

from __future__ import annotations

from pyspark.sql.types import StructType

# --- fixed values: column names and types of the exchanged tables --------------
BRONZE_FACILITY = (
    "PRVDR_NUM string, FAC_NM string, CITY string, STATE_CD string, ZIP_CD string, FIPS_CNTY_CD string, "
    "CRTFD_BED_CNT string, FAC_TYPE_CD string, CRTFCTN_DT string"
)
BRONZE_UTILIZATION = (
    "hospital_pk string, hospital_name string, state string, fips_code string, collection_week string, "
    "total_beds_7_day_avg string, inpatient_beds_used_7_day_avg string, "
    "total_staffed_adult_icu_beds_7_day_avg string, icu_beds_used_7_day_avg string, "
    "total_adult_patients_hospitalized_confirmed_and_suspected_covid_7_day_avg string"
)
QUALITY_LOG = (
    "source string, process_date date, total_rows bigint, clean_rows bigint, quarantine_rows bigint, "
    "quarantine_rate double, logged_at timestamp"
)
EXT_GEOGRAPHY = (
    "county_fips string, county_name string, state_code string, state_name string, hrr_region string, "
    "area_km2 double"
)
EXT_HOSPITAL = (
    "hospital_id string, hospital_name string, hospital_type string, ownership_type string, "
    "rural_urban_flag string, staffed_beds_capacity bigint, icu_beds_capacity bigint, total_fte_staff double, "
    "certified_bed_count bigint, zip_code string, state string, county_fips string, latitude double, "
    "longitude double"
)
EXT_POPULATION = (
    "county_fips string, census_year int, total_population bigint, pop_65_plus_pct double, "
    "population_density double, median_household_income double, poverty_rate_pct double, "
    "uninsured_rate_pct double, physicians_per_100k double, nurses_per_100k double, rucc_code int, "
    "rucc_description string, ingestion_timestamp timestamp"
)
PREDICTION_RAW = (
    "model_name string NOT NULL, hospital_id string NOT NULL, report_date date NOT NULL, "
    "run_date date NOT NULL, pred_occupancy_next_week double NOT NULL, pred_high_strain bigint NOT NULL, "
    "pred_high_strain_prob double NOT NULL, actual_occupancy double, actual_high_strain bigint, "
    "abs_error double, shap_base_value double, top1_feature string, top1_shap double, "
    "top1_direction string, top2_feature string, top2_shap double, top2_direction string, "
    "top3_feature string, top3_shap double, top3_direction string, explanation string, "
    "model_version string, data_source string, predicted_at timestamp NOT NULL"
)
OBSERVABILITY_COLUMNS = (
    "model_name", "hospital_id", "report_date", "run_date", "pred_occupancy_next_week", "pred_high_strain",
    "pred_high_strain_prob", "actual_occupancy", "actual_high_strain", "abs_error", "shap_base_value",
    "top1_feature", "top1_shap", "top1_direction", "top2_feature", "top2_shap", "top2_direction",
    "top3_feature", "top3_shap", "top3_direction", "explanation",
)


def struct(ddl: str) -> StructType:
    return StructType.fromDDL(ddl)


def field_types(ddl: str) -> dict[str, str]:
    return {f.name: f.dataType.simpleString() for f in struct(ddl).fields}


def required_columns(ddl: str) -> list[str]:
    return [f.name for f in struct(ddl).fields if not f.nullable]
