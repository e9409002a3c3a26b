"""Results depend on them, so they are stated here and nowhere else."""

from __future__ import annotations

# --- fixed values: text that means "no value" in stringified payloads --------
MISSING_TEXT = ("nan", "NaN", "None", "")

# --- fixed values: state FIPS prefix -> postal abbreviation -------------------
STATE_BY_FIPS = {
    "01": "AL", "02": "AK", "04": "AZ", "05": "AR", "06": "CA", "08": "CO", "09": "CT", "10": "DE",
    "11": "DC", "12": "FL", "13": "GA", "15": "HI", "16": "ID", "17": "IL", "18": "IN", "19": "IA",
    "20": "KS", "21": "KY", "22": "LA", "23": "ME", "24": "MD", "25": "MA", "26": "MI", "27": "MN",
    "28": "MS", "29": "MO", "30": "MT", "31": "NE", "32": "NV", "33": "NH", "34": "NJ", "35": "NM",
    "36": "NY", "37": "NC", "38": "ND", "39": "OH", "40": "OK", "41": "OR", "42": "PA", "44": "RI",
    "45": "SC", "46": "SD", "47": "TN", "48": "TX", "49": "UT", "50": "VT", "51": "VA", "53": "WA",
    "54": "WV", "55": "WI", "56": "WY", "72": "PR",
}

# --- fixed values: name suffixes of administrative areas ----------------------
AREA_SUFFIXES = ("County", "Parish", "Borough", "Census Area", "Municipality")

# --- fixed values: units, thresholds, windows ---------------------------------
SQ_MI_TO_KM2 = 2.58999
CRITICAL_OCCUPANCY = 0.9
WARNING_OCCUPANCY = 0.7
OVERLOAD_OCCUPANCY = 0.9
HIGH_STRAIN_OCCUPANCY = 0.85
PERSISTENT_OVERLOAD = 0.8
PERSISTENT_WEEKS = 4
ALERT_THRESHOLD = 0.90
INTERVAL_HALF_WIDTH = 0.05
FORECAST_DAYS = 7
SENTINEL = -9999
MAX_BAD_RATE = 0.20
MAX_UNMAPPED_RATE = 0.05
MAX_NULL_TARGET_RATE = 0.05
MAX_UNMATCHED_NAME_RATE = 0.05
STALE_AFTER_DAYS = 40
STAGING_DAYS = 7
MERGE_DAYS = 14
SERVING_LOOKBACK_DAYS = 3
SCORING_LOOKBACK_DAYS = 40
TREND_DAYS = 28
REPORT_ROWS = 100
SEARCH_ROWS = 10
PANEL_START = "2020-08-01"
TRAIN_END = "2022-12-31"
VALIDATION_END = "2023-09-30"
MIN_ROWS_PER_SPLIT = 500
MIN_TRAINING_ROWS = 10_000
MAX_PERCENTAGE = 200.0
PRIMARY_MODEL = "XGBoost"
PIPELINE_VERSION = "v1.0"
NO_WATERMARK = "1900-01-01"

# --- fixed values: row-level rule codes ---------------------------------------
RULE_FUTURE_DATE = "R6_future_report_date"
RULE_OVER_120 = "R1_occupancy_over_120"
RULE_ICU_USED = "R2_icu_used_gt_staffed"
RULE_ICU_TOTAL = "R3_icu_gt_total_beds"
RULE_ZERO_BEDS = "R4_zero_beds_but_patients"
RULE_COVID_TOTAL = "R5_covid_gt_total"
RULE_NO_KEY = "R7_missing_key"
GEOGRAPHY_GATE_REASON = "DQ_FAIL: Invalid FIPS or missing state_code"
POPULATION_GATE_REASON = "DQ_FAIL: invalid FIPS, null year, or negative population"

# --- fixed values: model gate --------------------------------------------------
GATE_MAE = 0.10
GATE_R2 = 0.75
GATE_AUC = 0.85
GATE_TOLERANCE = 0.005

# --- fixed values: columns a model must not see, and its categorical columns ---
NON_FEATURES = (
    "hospital_id", "report_date", "county_fips", "zip_code", "county_name", "hospital_name", "city",
    "feature_computed_at", "target_occupancy_next_week", "target_high_strain", "occupancy_rate",
)
CATEGORICAL_FEATURES = (
    "state", "hospital_type", "season", "disease_season", "healthcare_risk_level",
    "metro_nonmetro_flag", "hrr_region",
)
LEAKAGE_KEYWORDS = ("_next_week", "target_", "_next_", "next_week_")
SENTINEL_COLUMNS = (
    "icu_used", "icu_occupancy_rate", "covid_patients", "covid_icu", "flu_patients", "flu_icu",
    "covid_admit_adult",
)

# --- fixed values: census variables of the 65+ age bands -----------------------
AGE_65_PLUS = (
    "B01001_020E", "B01001_021E", "B01001_022E", "B01001_023E", "B01001_024E", "B01001_025E",
    "B01001_044E", "B01001_045E", "B01001_046E", "B01001_047E", "B01001_048E", "B01001_049E",
)
