"""Panel windows, the feature store and the prediction tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardmill.checks import views as V
from wardmill.checks.registry import Tables, check
from wardmill.checks.views import oracle
from wardmill.checks.views import rounded as _rounded
from wardmill.operators import panel as P
from wardmill.operators.dedup import keep_latest
from wardmill.operators.incremental import late_window, newer_than_target
from wardmill.operators.ordered import rank_within
from wardmill.operators.shape import stack
from wardmill.plans import serving as SV
from wardmill.plans.dimensions import dim_date_of
from wardmill.plans.fact import with_rates
from wardmill.plans.feature_refresh import Dimensions, note_changes, refresh_features
from wardmill.plans.features import (
    CALENDAR,
    CALENDAR_FLAGS,
    CALENDAR_LABELS,
    CHANGE,
    FEATURE_COLUMNS,
    GEOGRAPHY,
    LABEL,
    LAGS,
    LEVELS,
    POPULATION,
    ROLLING,
    TARGET,
    facility_attributes,
    feature_weekly,
)
from wardmill.session import staging_path
from wardmill.sources import writers as W

c = F.col


def _panel(t: Tables) -> DataFrame:
    return V.fact(t).select(
        "hospital_id", "collection_week", c("inpatient_occupancy_rate").alias("rate"), "icu_occupancy_rate",
        "ed_visits_total",
    )


@check("W07 W12 D08", oracle("""
SELECT hospital_id, collection_week, round(lag(inpatient_occupancy_rate, 1) OVER w, 6) AS lag1,
  round(lag(inpatient_occupancy_rate, 4) OVER w, 6) AS lag4, round(lag(inpatient_occupancy_rate, 12) OVER w, 6) AS lag12,
  round(lag(icu_occupancy_rate, 1) OVER w, 6) AS icu_lag1,
  round((inpatient_occupancy_rate - lag(inpatient_occupancy_rate, 1) OVER w)
    / NULLIF(lag(inpatient_occupancy_rate, 1) OVER w, 0), 6) AS change
FROM v_fact WINDOW w AS (PARTITION BY hospital_id ORDER BY collection_week)
""", "v_fact"))
def lagged_panel(t: Tables) -> DataFrame:
    w = P.panel_window("hospital_id", "collection_week")
    spec = {"rate": [(1, "lag1"), (4, "lag4"), (12, "lag12")], "icu_occupancy_rate": [(1, "icu_lag1")]}
    df = P.add_change(P.add_lags(_panel(t), spec, w), "rate", "change", w)
    return _rounded(df.select("hospital_id", "collection_week", "lag1", "lag4", "lag12", "icu_lag1", "change"))


@check("W08 W13", oracle("""
SELECT hospital_id, collection_week, round(target, 6) AS target, round(lag4, 6) AS lag4 FROM (
  SELECT hospital_id, collection_week, lead(inpatient_occupancy_rate, 1) OVER w AS target,
    lag(inpatient_occupancy_rate, 4) OVER w AS lag4
  FROM v_fact WINDOW w AS (PARTITION BY hospital_id ORDER BY collection_week)) g
WHERE target IS NOT NULL AND lag4 IS NOT NULL
""", "v_fact"))
def complete_panel(t: Tables) -> DataFrame:
    w = P.panel_window("hospital_id", "collection_week")
    df = P.add_next(P.add_lags(_panel(t), {"rate": [(4, "lag4")]}, w), "rate", "target", w)
    return _rounded(P.complete_rows(df, ["target", "lag4"]).select("hospital_id", "collection_week", "target", "lag4"))


@check("W09", oracle("""
SELECT hospital_id, collection_week,
  round(avg(inpatient_occupancy_rate) OVER (w ROWS BETWEEN 3 PRECEDING AND CURRENT ROW), 6) AS roll4,
  round(avg(inpatient_occupancy_rate) OVER (w ROWS BETWEEN 7 PRECEDING AND CURRENT ROW), 6) AS roll8,
  round(avg(ed_visits_total) OVER (w ROWS BETWEEN 3 PRECEDING AND CURRENT ROW), 6) AS ed_roll4
FROM v_fact WINDOW w AS (PARTITION BY hospital_id ORDER BY collection_week)
""", "v_fact"))
def rolling_panel(t: Tables) -> DataFrame:
    w = P.panel_window("hospital_id", "collection_week")
    spec = {"rate": [(4, "roll4"), (8, "roll8")], "ed_visits_total": [(4, "ed_roll4")]}
    df = P.add_rolling(_panel(t), spec, w)
    return _rounded(df.select("hospital_id", "collection_week", "roll4", "roll8", "ed_roll4"))


@check("W07", oracle("""
WITH spans AS (SELECT hospital_id, MIN(collection_week) AS f, MAX(collection_week) AS l FROM v_fact GROUP BY 1),
weeks AS (SELECT hospital_id, CAST(unnest(generate_series(f, l, INTERVAL 7 DAY)) AS DATE) AS collection_week FROM spans)
SELECT w.hospital_id, w.collection_week, round(inpatient_occupancy_rate, 6) AS rate,
  round(lag(inpatient_occupancy_rate, 4) OVER (PARTITION BY w.hospital_id ORDER BY w.collection_week), 6) AS lag4
FROM weeks w LEFT JOIN v_fact f ON w.hospital_id = f.hospital_id AND w.collection_week = f.collection_week
""", "v_fact"))
def calendar_lags(t: Tables) -> DataFrame:
    w = P.panel_window("hospital_id", "collection_week")
    dense = P.densify_weeks(_panel(t).select("hospital_id", "collection_week", "rate"), "hospital_id", "collection_week")
    return _rounded(P.add_lags(dense, {"rate": [(4, "lag4")]}, w))


@check("W10", oracle("""
SELECT s_suppkey AS facility, s_nationkey % 5 AS region_key, s_acctbal,
  rank() OVER (PARTITION BY s_nationkey % 5 ORDER BY s_acctbal DESC) AS position
FROM supplier
"""))
def ranked_in_groups(t: Tables) -> DataFrame:
    rows = t.supplier.select(
        c("s_suppkey").alias("facility"), (c("s_nationkey") % 5).alias("region_key"), "s_acctbal"
    )
    return rank_within(rows, ["region_key"], "s_acctbal", "position")


@check("W10", """
SELECT l_orderkey, l_linenumber, l_returnflag, l_quantity,
  rank() OVER (PARTITION BY l_returnflag ORDER BY l_quantity DESC) AS position
FROM lineitem
""")
def ranked_with_ties(t: Tables) -> DataFrame:
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_returnflag", "l_quantity")
    return rank_within(rows, ["l_returnflag"], "l_quantity", "position")


PERSISTENT_SQL = """
SELECT hospital_id, MIN(collection_week) AS run_start, MAX(collection_week) AS run_end, COUNT(*) AS n_weeks,
  MAX(rate) AS peak_rate
FROM (SELECT hospital_id, collection_week, inpatient_occupancy_rate AS rate,
    row_number() OVER (PARTITION BY hospital_id ORDER BY collection_week)
      - row_number() OVER (PARTITION BY hospital_id, inpatient_occupancy_rate > CAST(0.8 AS DOUBLE)
        ORDER BY collection_week) AS run, inpatient_occupancy_rate > CAST(0.8 AS DOUBLE) AS busy
  FROM v_fact) g WHERE busy GROUP BY hospital_id, run HAVING COUNT(*) >= 4
"""


@check("W11", oracle(f"SELECT * REPLACE (round(peak_rate, 6) AS peak_rate) FROM ({PERSISTENT_SQL}) p", "v_fact"))
def overload_runs(t: Tables) -> DataFrame:
    return _rounded(P.persistent_overload(_panel(t), "hospital_id", "collection_week", "rate"))


@check("U03", oracle("""
SELECT CASE WHEN collection_week <= DATE '1998-12-31' THEN 'train' WHEN collection_week <= DATE '2000-06-30' THEN 'val'
  ELSE 'test' END AS split, COUNT(*) AS n, MIN(collection_week) AS first_week, MAX(collection_week) AS last_week
FROM v_fact GROUP BY 1
""", "v_fact"))
def split_sizes(t: Tables) -> DataFrame:
    split = P.temporal_split(V.fact(t), "collection_week", "1998-12-31", "2000-06-30")
    return split.groupBy("split").agg(
        F.count(F.lit(1)).alias("n"), F.min("collection_week").alias("first_week"),
        F.max("collection_week").alias("last_week"),
    )


def features(t: Tables) -> DataFrame:
    return feature_weekly(
        V.fact(t), dim_date_of(t.lineitem, "l_shipdate"), V.hospitals(t), V.population(t), V.geography(t),
    )


def _feature_sql() -> str:
    levels = ", ".join(f"COALESCE({source}, 0) AS {name}" for name, source in LEVELS.items())
    lags = ", ".join(f"lag({col}, {n}) OVER w AS {a}" for col, items in LAGS.items() for n, a in items)
    rolls = ", ".join(
        f"avg({col}) OVER (w ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) AS {a}"
        for col, items in ROLLING.items() for n, a in items
    )
    windows = [a for items in (*LAGS.values(), *ROLLING.values()) for _, a in items]
    rounded = [*LEVELS, *windows, CHANGE, TARGET]
    return f"""
WITH base AS (
  SELECT hospital_id, collection_week AS report_date, state, {levels}, CAST(is_corrected AS INTEGER) AS is_corrected,
    {", ".join(CALENDAR)}, {", ".join(f"CAST({n} AS INTEGER) AS {n}" for n in CALENDAR_FLAGS)},
    {", ".join(CALENDAR_LABELS)}
  FROM v_fact LEFT JOIN v_calendar ON collection_week = full_date
  WHERE inpatient_beds_capacity > 0),
windowed AS (
  SELECT *, {lags}, {rolls},
    (occupancy_rate - lag(occupancy_rate, 1) OVER w) / NULLIF(lag(occupancy_rate, 1) OVER w, 0) AS {CHANGE},
    lead(occupancy_rate, 1) OVER w AS {TARGET}
  FROM base WINDOW w AS (PARTITION BY hospital_id ORDER BY report_date)),
county AS (
  SELECT p.county_fips, {", ".join(POPULATION)}, {", ".join(GEOGRAPHY)}
  FROM v_population p LEFT JOIN v_geography g ON p.county_fips = g.county_fips
  WHERE census_year = (SELECT MAX(census_year) FROM v_population))
SELECT l.hospital_id, report_date, l.state, hospital_name, zip_code, {", ".join(f"round({n}, 6) AS {n}" for n in rounded)},
  is_corrected, {", ".join((*CALENDAR, *CALENDAR_FLAGS, *CALENDAR_LABELS))}, hospital_type,
  COALESCE(certified_bed_count, 0) AS certified_bed_count, h.county_fips, {", ".join(POPULATION)}, {", ".join(GEOGRAPHY)},
  CAST({TARGET} > CAST(0.85 AS DOUBLE) AS INTEGER) AS {LABEL}
FROM windowed l LEFT JOIN v_hospitals h ON l.hospital_id = h.hospital_id
LEFT JOIN county c ON h.county_fips = c.county_fips
WHERE {TARGET} IS NOT NULL AND occ_lag4 IS NOT NULL
"""


@check("B13 J04 J05 J06 P20 W07 W08 W09 W13 D11 F04 F07",
       oracle(_feature_sql(), "v_fact", "v_calendar", "v_hospitals", "v_population", "v_geography"))
def feature_store(t: Tables) -> DataFrame:
    windows = [a for items in (*LAGS.values(), *ROLLING.values()) for _, a in items]
    return features(t).withColumns({n: F.round(n, 6) for n in (*LEVELS, *windows, CHANGE, TARGET)})


_LATE = """collection_week BETWEEN DATE '1997-03-03' AND DATE '1997-03-24' AND
  (CAST(hospital_id AS BIGINT) + day(collection_week)) % 3"""


@check("B13 W07 W08 W09 I03", oracle(_feature_sql().replace("FROM v_fact LEFT", "FROM late_fact LEFT").replace("WITH base AS (", f"""
WITH late_fact AS (SELECT * REPLACE (CASE WHEN {_LATE} = 2 THEN 0 ELSE inpatient_beds_capacity END AS inpatient_beds_capacity) FROM v_fact),
base AS (""", 1), "v_fact", "v_calendar", "v_hospitals", "v_population", "v_geography"))
def feature_store_after_late_rows(t: Tables) -> DataFrame:
    """Built while rows of four weeks are missing or wrong; then these are merged late, others withdrawn, and only their reach is recomputed."""
    root, day = staging_path(t.spark, "late-rows"), "2030-01-01"
    late = lambda k: F.expr(f"{_LATE} = {k}")
    truth = V.fact(t)
    before = truth.filter(~late(0)).withColumn("inpatient_beds_used", F.when(late(1), c("inpatient_beds_used") / 2).otherwise(c("inpatient_beds_used")))
    W.overwrite_partition(with_rates(before), f"{root}/fact", ["collection_week"])
    dimensions = Dimensions(dim_date_of(t.lineitem, "l_shipdate"), facility_attributes(V.hospitals(t), V.population(t), V.geography(t)))
    refresh_features(t.spark, f"{root}/features", f"{root}/fact", dimensions, day)
    batch = truth.filter(late(0) | late(1) | late(2)).withColumn("inpatient_beds_capacity", F.when(late(2), 0.0).otherwise(c("inpatient_beds_capacity")))
    note_changes(t.spark, f"{root}/features", batch)
    W.upsert_partitions(t.spark, f"{root}/fact", batch, ["hospital_id", "collection_week"], "collection_week")
    refresh_features(t.spark, f"{root}/features", f"{root}/fact", dimensions, day)
    windows = [a for items in (*LAGS.values(), *ROLLING.values()) for _, a in items]
    built = t.spark.read.parquet(f"{root}/features").select(*FEATURE_COLUMNS)
    return built.withColumns({n: F.round(n, 6) for n in (*LEVELS, *windows, CHANGE, TARGET)})


# --- prediction tables ---------------------------------------------------------------------


@check("B14 P06", oracle("""
SELECT model_name, hospital_id, report_date, run_date, pred_occupancy_next_week, pred_high_strain,
  pred_high_strain_prob, actual_occupancy, actual_high_strain, abs_error, shap_base_value, top1_feature, top1_shap,
  top1_direction, top2_feature, top2_shap, top2_direction, top3_feature, top3_shap, top3_direction, explanation
FROM v_predictions
""", "v_predictions"))
def observability_table(t: Tables) -> DataFrame:
    return SV.observability(V.predictions(t))


@check("B15 F09 J07 P24 P26 D12 D13 D14", oracle("""
SELECT * REPLACE (round(confidence_lower_95, 6) AS confidence_lower_95, round(confidence_upper_95, 6)
  AS confidence_upper_95) FROM v_forecast
""", "v_forecast"))
def forecast_table(t: Tables) -> DataFrame:
    return _rounded(SV.forecast_serving(V.predictions(t), V.hospitals(t)))


LATEST_SQL = """
SELECT * EXCLUDE (rn) FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY hospital_id, forecast_date
  ORDER BY run_date DESC, forecast_id DESC) AS rn FROM v_forecast) r WHERE rn = 1
"""


@check("W03", oracle(f"""
SELECT hospital_id, forecast_date, run_date, forecast_id FROM ({LATEST_SQL}) l
""", "v_forecast"))
def newest_forecasts(t: Tables) -> DataFrame:
    rows = SV.forecast_serving(V.predictions(t), V.hospitals(t))
    return keep_latest(rows, ["hospital_id", "forecast_date"], "run_date", "forecast_id").select(
        "hospital_id", "forecast_date", "run_date", "forecast_id"
    )


@check("B16 W04 P25", oracle(f"""
SELECT * EXCLUDE (forecast_id) REPLACE (round(confidence_lower_95, 6) AS confidence_lower_95,
  round(confidence_upper_95, 6) AS confidence_upper_95) FROM ({LATEST_SQL}) l
""", "v_forecast"))
def latest_forecast_table(t: Tables) -> DataFrame:
    shaped = SV.forecast_serving(V.predictions(t), V.hospitals(t)).withColumns({
        "run_date": c("run_date").cast("string"), "forecast_date": c("forecast_date").cast("string")
    })
    return _rounded(SV.forecast_latest(shaped, V.hospitals(t)))


@check("B17 W03 J05", oracle(f"""
SELECT l.forecast_id, l.hospital_id, h.hospital_name, h.county_fips, county_name, latitude, longitude, certified_bed_count,
  forecast_date, run_date, predicted_occupancy_rate,
  round(predicted_occupancy_rate * certified_bed_count, 6) AS predicted_patient_volume,
  round(confidence_lower_95, 6) AS confidence_lower_95, round(confidence_upper_95, 6) AS confidence_upper_95,
  shap_feature_1, shap_feature_2, shap_feature_3, model_version,
  predicted_occupancy_rate > CAST(0.9 AS DOUBLE) AS alert_flag
FROM ({LATEST_SQL}) l LEFT JOIN v_hospitals h ON l.hospital_id = h.hospital_id
LEFT JOIN v_geography g ON h.county_fips = g.county_fips
""", "v_forecast", "v_hospitals", "v_geography"))
def enriched_forecast_table(t: Tables) -> DataFrame:
    forecast = SV.forecast_serving(V.predictions(t), V.hospitals(t))
    return _rounded(SV.forecast_enriched(forecast, V.hospitals(t), V.geography(t)))


EARLIER_SQL = "(SELECT * FROM v_forecast WHERE run_date < (SELECT MAX(run_date) FROM v_forecast))"


def _newest_since(bound: str) -> str:
    return f"""(SELECT * EXCLUDE (rn) FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY hospital_id, forecast_date
      ORDER BY run_date DESC, forecast_id DESC) AS rn FROM v_forecast WHERE run_date {bound}) r WHERE rn = 1)"""


def _earlier(forecast: DataFrame) -> DataFrame:
    """What a serving table held before the newest run."""
    return forecast.filter(c("run_date") < forecast.agg(F.max("run_date")).scalar())


@check("B16 I01", oracle(f"""
SELECT hospital_id, hospital_name, forecast_date, run_date, predicted_occupancy_rate, alert_flag
FROM {_newest_since(f"> COALESCE((SELECT MAX(run_date) FROM {EARLIER_SQL} e), DATE '1900-01-01')")} l
""", "v_forecast"))
def latest_forecasts_of_new_runs(t: Tables) -> DataFrame:
    forecast = SV.forecast_serving(V.predictions(t), V.hospitals(t))
    latest = SV.forecast_latest(forecast, V.hospitals(t), _earlier(forecast))
    return latest.select("hospital_id", "hospital_name", "forecast_date", "run_date", "predicted_occupancy_rate", "alert_flag")


@check("B17 I02", oracle(f"""
SELECT l.forecast_id, l.hospital_id, county_name, forecast_date, run_date, predicted_occupancy_rate,
  round(predicted_occupancy_rate * certified_bed_count, 6) AS predicted_patient_volume
FROM {_newest_since(f">= COALESCE((SELECT MAX(run_date) FROM {EARLIER_SQL} e) - 3, DATE '1900-01-01')")} l
LEFT JOIN v_hospitals h ON l.hospital_id = h.hospital_id LEFT JOIN v_geography g ON h.county_fips = g.county_fips
""", "v_forecast", "v_hospitals", "v_geography"))
def enriched_forecasts_of_late_runs(t: Tables) -> DataFrame:
    forecast = SV.forecast_serving(V.predictions(t), V.hospitals(t))
    rows = SV.forecast_enriched(forecast, V.hospitals(t), V.geography(t), _earlier(forecast))
    return _rounded(rows.select("forecast_id", "hospital_id", "county_name", "forecast_date", "run_date", "predicted_occupancy_rate",
                                "predicted_patient_volume"))


@check("I01 I02 SK12", oracle("""
SELECT 'newer' AS part, COUNT(*) AS n FROM v_predictions
  WHERE run_date > (SELECT MAX(run_date) FROM v_predictions WHERE run_date <= DATE '2024-01-20')
UNION ALL
SELECT 'late window', COUNT(*) FROM v_predictions
  WHERE run_date >= (SELECT MAX(run_date) - 3 FROM v_predictions WHERE run_date <= DATE '2024-01-20')
""", "v_predictions"))
def incremental_windows(t: Tables) -> DataFrame:
    rows = V.predictions(t)
    target = rows.filter(c("run_date") <= F.lit("2024-01-20").cast("date"))
    parts = {"newer": newer_than_target(target, rows, "run_date"),
             "late window": late_window(target, rows, "run_date", 3)}
    return stack([
        df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("part"), "n") for name, df in parts.items()
    ])
