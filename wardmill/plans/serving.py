"""Raw predictions to monitoring and serving tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardmill.constants import ALERT_THRESHOLD, PRIMARY_MODEL, SERVING_LOOKBACK_DAYS
from wardmill.functions.keys import stable_id
from wardmill.functions.measures import alert_flag, forecast_date, interval
from wardmill.operators.attribution import to_serving_columns
from wardmill.operators.dedup import keep_latest
from wardmill.operators.incremental import late_window, newer_than_target
from wardmill.operators.shape import fill_defaults
from wardmill.schemas import OBSERVABILITY_COLUMNS, PREDICTION_RAW, field_types

# --- fixed values: serving columns ---------------------------------------------------
ATTRIBUTION = (
    "shap_feature_1", "shap_feature_2", "shap_feature_3", "shap_value_1", "shap_value_2", "shap_value_3",
)
SERVING_COLUMNS = (
    "forecast_id", "hospital_id", "hospital_name", "state", "run_date", "forecast_date",
    "predicted_occupancy_rate", "confidence_lower_95", "confidence_upper_95", "alert_flag", *ATTRIBUTION,
    "model_version",
)
LATEST_COLUMNS = tuple(c for c in SERVING_COLUMNS if c != "forecast_id")
ENRICHED_COLUMNS = (
    "forecast_id", "hospital_id", "hospital_name", "county_fips", "county_name", "latitude", "longitude",
    "certified_bed_count", "forecast_date", "run_date", "predicted_occupancy_rate", "predicted_patient_volume",
    "confidence_lower_95", "confidence_upper_95", "shap_feature_1", "shap_feature_2", "shap_feature_3",
    "model_version", "alert_flag",
)


def observability(raw: DataFrame, run_date: str | None = None) -> DataFrame:
    """All models, typed, nothing renamed. Bad dates become NULL."""
    types = field_types(PREDICTION_RAW)
    rows = raw if run_date is None else raw.filter(F.col("run_date") == F.lit(run_date).cast("date"))
    return rows.select(*[F.col(n).try_cast(types[n]).alias(n) for n in OBSERVABILITY_COLUMNS])


def observability_since(raw: DataFrame, target: DataFrame) -> DataFrame:
    """Rows newer than the monitoring table's newest report date."""
    return newer_than_target(target, observability(raw), "report_date")


def forecast_serving(
    raw: DataFrame, hospitals: DataFrame, run_date: str | None = None, primary: str = PRIMARY_MODEL
) -> DataFrame:
    """Primary-model rows with interval, alert and facility names; unmatched facilities stay."""
    c = F.col
    rows = raw.filter(c("model_name") == primary)
    if run_date is not None:
        rows = rows.filter(c("run_date") == F.lit(run_date).cast("date"))
    prediction = c("pred_occupancy_next_week")
    lower, upper = interval(prediction)
    names = hospitals.select("hospital_id", "hospital_name", F.col("state").alias("_state"))
    served = to_serving_columns(rows.drop("state")).join(names, ["hospital_id"], "left")
    return served.withColumns({
        "forecast_id": stable_id(c("model_name"), c("hospital_id"), c("report_date"), c("run_date")),
        "state": c("_state"),
        "forecast_date": forecast_date(c("report_date").try_cast("date")),
        "predicted_occupancy_rate": prediction,
        "confidence_lower_95": lower,
        "confidence_upper_95": upper,
        "alert_flag": alert_flag(prediction),
    }).select(*SERVING_COLUMNS)


def forecast_latest(
    shaped: DataFrame, hospitals: DataFrame, target: DataFrame | None = None, threshold: float = ALERT_THRESHOLD
) -> DataFrame:
    """Pre-shaped predictions to one row per facility and forecast date, the newest run.

    With a ``target`` only runs after its newest one are taken.
    """
    c = F.col
    rows = shaped.withColumns({
        "run_date": c("run_date").try_cast("date"), "forecast_date": c("forecast_date").try_cast("date"),
    })
    if target is not None:
        rows = newer_than_target(target, rows, "run_date")
    # The choice needs only prediction columns, so it comes before the join and shrinks it.
    newest = keep_latest(rows, ["hospital_id", "forecast_date"], "run_date")
    names = hospitals.select("hospital_id", "hospital_name", "state")
    flagged = newest.drop("hospital_name", "state").withColumn(
        "alert_flag", F.coalesce(alert_flag(c("predicted_occupancy_rate"), threshold), F.lit(False))
    )
    return flagged.join(names, ["hospital_id"], "left").select(*LATEST_COLUMNS)


def forecast_enriched(
    forecast: DataFrame, hospitals: DataFrame, geography: DataFrame, target: DataFrame | None = None,
    lookback_days: int = SERVING_LOOKBACK_DAYS, threshold: float = ALERT_THRESHOLD,
) -> DataFrame:
    """Dashboard rows: newest forecast per facility and date with place and capacity.

    With a ``target`` only runs of its last days are re-read (late data), ready
    to be upserted. The patient volume has no producer in the source models; it
    is defined here as rate times certified beds.
    """
    c = F.col
    rows = forecast if target is None else late_window(target, forecast, "run_date", lookback_days)
    newest = keep_latest(rows, ["hospital_id", "forecast_date"], "run_date", "forecast_id")
    places = hospitals.select(
        "hospital_id", "hospital_name", "county_fips", "latitude", "longitude", "certified_bed_count"
    ).join(geography.select("county_fips", "county_name"), ["county_fips"], "left")
    joined = newest.drop("hospital_name", "alert_flag").join(places, ["hospital_id"], "left")
    return fill_defaults(
        joined.withColumns({
            "predicted_patient_volume": c("predicted_occupancy_rate") * c("certified_bed_count"),
            "alert_flag": alert_flag(c("predicted_occupancy_rate"), threshold, inclusive=False),
        }),
        {"alert_flag": False},
    ).select(*ENRICHED_COLUMNS)
