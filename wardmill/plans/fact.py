"""The weekly utilisation fact: one row per facility and week, rates as fractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardmill.constants import PIPELINE_VERSION, STAGING_DAYS
from wardmill.functions.cleaning import round_to_integer
from wardmill.functions.dates import within_days
from wardmill.functions.keys import surrogate_key
from wardmill.functions.measures import occupancy_rate, overload_flag

# --- fixed values: fact columns ------------------------------------------------------
FACT_COUNTS = (
    "inpatient_beds_capacity", "inpatient_beds_used", "icu_beds_capacity", "icu_beds_used",
    "covid_hospitalized_patients", "covid_icu_patients", "influenza_hospitalized_patients",
    "influenza_icu_patients", "ed_visits_total", "covid_admissions_adult", "covid_admissions_pediatric",
    "pediatric_beds_capacity", "pediatric_beds_used",
)
FACT_KEYS = ("hospital_id", "collection_week")


def with_rates(df: DataFrame) -> DataFrame:
    inpatient = occupancy_rate(F.col("inpatient_beds_used"), F.col("inpatient_beds_capacity"))
    icu = occupancy_rate(F.col("icu_beds_used"), F.col("icu_beds_capacity"))
    return df.withColumns({
        "inpatient_occupancy_rate": inpatient,
        "icu_occupancy_rate": icu,
        "overload_flag": overload_flag(inpatient),
    })


def stage_fact(df: DataFrame, as_of: str, days: int = STAGING_DAYS, audit: bool = True) -> DataFrame:
    """Trailing delta of the source, typed and keyed, ready to merge.

    The date condition is on the bare partition column, so only the delta's
    partitions are read.
    """
    c = F.col
    delta = df.filter(within_days(c("collection_week"), as_of, days))
    typed = delta.select(
        surrogate_key(c("hospital_id"), c("collection_week")).alias("fact_id"),
        "hospital_id",
        c("collection_week").cast("date").alias("collection_week"),
        "state",
        *[
            (round_to_integer(c(n)) if n in df.columns else F.lit(None).cast("bigint")).alias(n)
            for n in FACT_COUNTS
        ],
        (F.coalesce(c("is_corrected").cast("boolean"), F.lit(False)) if "is_corrected" in df.columns
         else F.lit(False)).alias("is_corrected"),
    )
    rated = with_rates(typed)
    if not audit:
        return rated
    return rated.withColumns({
        "dwh_updated_at": F.lit(as_of).cast("timestamp"),
        "pipeline_version": F.lit(PIPELINE_VERSION),
    })
