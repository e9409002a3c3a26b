"""Row rules, gates, assertions and table checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardmill.checks import views as V
from wardmill.checks.registry import Tables, check
from wardmill.checks.tables import GEOGRAPHY_SILVER, SILVER_UTILIZATION, county_sources
from wardmill.checks.views import oracle
from wardmill.operators import quality as Q
from wardmill.operators.aggregates import range_anomalies
from wardmill.plans.serving import forecast_serving, observability
from wardmill.plans.silver import silver_geography, silver_utilization

c = F.col

RULES_SQL = f"""
SELECT *, CASE WHEN report_date > DATE '2001-06-30' THEN 'R6_future_report_date' END AS r6,
  CASE WHEN occupancy_rate > 120 THEN 'R1_occupancy_over_120' END AS r1,
  CASE WHEN icu_beds_used > icu_beds_staffed THEN 'R2_icu_used_gt_staffed' END AS r2,
  CASE WHEN icu_beds_staffed > inpatient_beds_total THEN 'R3_icu_gt_total_beds' END AS r3,
  CASE WHEN inpatient_beds_total = 0 AND inpatient_beds_used > 0 THEN 'R4_zero_beds_but_patients' END AS r4,
  CASE WHEN covid_patients > total_patients THEN 'R5_covid_gt_total' END AS r5,
  CASE WHEN provider_id IS NULL OR report_date IS NULL THEN 'R7_missing_key' END AS r7
FROM ({SILVER_UTILIZATION}) s
"""


def _ruled(t: Tables) -> DataFrame:
    return Q.apply_rules(silver_utilization(V.bronze_utilization(t)), Q.utilization_rules(V.AS_OF))


@check("Q01 Q02 Q03 X17 X18", oracle(f"""
SELECT provider_id, report_date, concat_ws(',', r6, r1, r2, r3, r4, r5, r7) AS violations,
  COALESCE(r6, r1, r2, r3, r4, r5, r7) AS first_code, COALESCE(r6, r1, r2, r3, r4, r5, r7) IS NOT NULL AS has_violation
FROM ({RULES_SQL}) r
""", "v_bronze_utilization"))
def rule_violations(t: Tables) -> DataFrame:
    return _ruled(t).select(
        "provider_id", "report_date", F.array_join("_violations", ",").alias("violations"),
        Q.first_violation(c("_violations")).alias("first_code"), c("_has_violation").alias("has_violation"),
    )


@check("A12", oracle(f"""
SELECT state, total_rows, clean_rows, quarantine_rows,
  round(CAST(quarantine_rows AS DOUBLE) / total_rows, 6) AS quarantine_rate
FROM (SELECT state, COUNT(*) AS total_rows, COUNT(*) FILTER (COALESCE(r6, r1, r2, r3, r4, r5, r7) IS NULL) AS clean_rows,
    COUNT(*) FILTER (COALESCE(r6, r1, r2, r3, r4, r5, r7) IS NOT NULL) AS quarantine_rows
  FROM ({RULES_SQL}) r GROUP BY 1) g
""", "v_bronze_utilization"))
def quarantine_statistics(t: Tables) -> DataFrame:
    stats = Q.quarantine_stats(_ruled(t), ["state"])
    return stats.withColumn("quarantine_rate", F.round("quarantine_rate", 6))


@check("Q04", f"""
SELECT error_reason, COUNT(*) AS n FROM ({GEOGRAPHY_SILVER}) s GROUP BY 1
""")
def geography_gate_counts(t: Tables) -> DataFrame:
    return silver_geography(*county_sources(t)).groupBy("error_reason").agg(F.count(F.lit(1)).alias("n"))


@check("Q05", """
SELECT county_fips, census_year, total_population, NOT ok AS _has_violation,
  CASE WHEN ok THEN NULL ELSE 'DQ_FAIL: invalid FIPS, null year, or negative population' END AS error_reason
FROM (SELECT *, COALESCE(regexp_full_match(county_fips, '[0-9]{5}') AND census_year IS NOT NULL AND total_population >= 0,
    FALSE) AS ok
  FROM (SELECT CASE WHEN c_mktsegment = 'BUILDING' THEN NULL WHEN c_mktsegment = 'MACHINERY' THEN '1234'
      ELSE lpad(CAST(c_nationkey AS VARCHAR), 5, '0') END AS county_fips,
      CASE WHEN c_nationkey = 3 THEN NULL ELSE c_nationkey + 2000 END AS census_year,
      CAST(floor(c_acctbal) AS BIGINT) AS total_population FROM customer) b) g
""")
def population_gated(t: Tables) -> DataFrame:
    code = F.when(c("c_mktsegment") == "MACHINERY", "1234").when(
        c("c_mktsegment") != "BUILDING", F.lpad(c("c_nationkey").cast("string"), 5, "0")
    )
    rows = t.customer.select(
        code.alias("county_fips"),
        F.when(c("c_nationkey") != 3, c("c_nationkey") + 2000).alias("census_year"),
        F.floor("c_acctbal").alias("total_population"),
    )
    return Q.population_gate(rows)


@check("Q07", oracle("""
SELECT hospital_id, collection_week, round(inpatient_occupancy_rate, 6) AS rate FROM v_fact
WHERE inpatient_occupancy_rate > 1.5 OR inpatient_beds_capacity < 0 OR inpatient_beds_used < 0
  OR (inpatient_beds_used > inpatient_beds_capacity AND inpatient_occupancy_rate <= 1)
""", "v_fact"))
def broken_assertion(t: Tables) -> DataFrame:
    broken = Q.utilization_assertion(
        c("inpatient_occupancy_rate"), c("inpatient_beds_capacity"), c("inpatient_beds_used")
    )
    return Q.assert_rule(V.fact(t), broken).select(
        "hospital_id", "collection_week", F.round("inpatient_occupancy_rate", 6).alias("rate")
    )


@check("Q08", """
SELECT l_orderkey, l_linenumber, COUNT(*) AS n_rows FROM lineitem GROUP BY 1, 2 HAVING COUNT(*) > 1
""")
def repeated_keys(t: Tables) -> DataFrame:
    return Q.assert_unique(t.lineitem, ["l_orderkey", "l_linenumber"])


@check("Q09", oracle("""
SELECT model_name, hospital_id, run_date FROM v_predictions WHERE top1_feature IS NULL OR top3_feature IS NULL
""", "v_predictions"))
def null_columns(t: Tables) -> DataFrame:
    broken = Q.assert_not_null(V.predictions(t), ["top1_feature", "top3_feature"])
    return broken.select("model_name", "hospital_id", "run_date")


@check("A09", oracle("""
SELECT column_name, round(null_rate, 6) AS null_rate FROM (
  SELECT 'icu_occupancy_rate' AS column_name, AVG(CASE WHEN icu_occupancy_rate IS NULL THEN 1.0 ELSE 0.0 END) AS null_rate
    FROM v_fact
  UNION ALL SELECT 'state', AVG(CASE WHEN state IS NULL THEN 1.0 ELSE 0.0 END) FROM v_fact) g
""", "v_fact"))
def column_null_rates(t: Tables) -> DataFrame:
    rates = Q.null_rates(V.fact(t), ["icu_occupancy_rate", "state"])
    return rates.withColumn("null_rate", F.round("null_rate", 6))


@check("A10", """
SELECT CAST(SUM(n - 1) AS BIGINT) AS n_duplicates FROM (
  SELECT l_orderkey, l_linenumber, COUNT(*) AS n FROM lineitem GROUP BY 1, 2) g
""")
def duplicate_rows(t: Tables) -> DataFrame:
    return Q.duplicate_count(t.lineitem, ["l_orderkey", "l_linenumber"])


@check("Q15", """
SELECT COUNT(*) AS n_rows, CAST(COUNT(*) - COUNT(DISTINCT (l_suppkey, CAST(l_shipdate AS DATE))) AS BIGINT) AS n_duplicates,
  CAST(0 AS DOUBLE) AS null_rate_hospital_id, CAST(0 AS DOUBLE) AS null_rate_report_date,
  round(AVG(CASE WHEN l_tax = 0 THEN 1.0 ELSE 0.0 END), 6) AS null_rate_target,
  AVG(CASE WHEN l_tax = 0 THEN 1.0 ELSE 0.0 END) <= 0.05 AS panel_ok
FROM lineitem
""")
def panel_validation(t: Tables) -> DataFrame:
    rows = t.lineitem.select(
        c("l_suppkey").alias("hospital_id"), c("l_shipdate").cast("date").alias("report_date"),
        F.when(c("l_tax") != 0, c("l_tax")).alias("target"),
    )
    report = Q.validate_panel(rows, ["hospital_id", "report_date"], ["target", "absent"])
    return report.withColumn("null_rate_target", F.round("null_rate_target", 6))


@check("A20 Q17", """
SELECT column_name, max_value FROM (
  SELECT 'value' AS column_name, MAX(value) AS max_value FROM events
  UNION ALL SELECT 'small', MAX(value / 10) FROM events) g WHERE max_value > 200
""")
def out_of_range(t: Tables) -> DataFrame:
    rows = t.events.select(c("value").cast("string").alias("value"), (c("value") / 10).alias("small"), "event_type")
    return range_anomalies(rows, ["value", "small", "absent"])


@check("Q10", oracle("""
SELECT CAST(COUNT(*) >= 1 AS INTEGER) AS has_rows,
  CAST(COUNT(*) FILTER (model_name = 'XGBoost') > 0 AS INTEGER) AS has_primary_model,
  CAST(COUNT(*) FILTER (pred_occupancy_next_week IS NULL) = 0 AS INTEGER) AS no_null_predictions,
  CAST(COUNT(*) FILTER (top1_feature IS NULL) = 0 AS INTEGER) AS no_null_attribution
FROM v_predictions WHERE run_date = DATE '2024-01-15'
""", "v_predictions"))
def prediction_checks(t: Tables) -> DataFrame:
    return Q.check_predictions(V.predictions(t), "2024-01-15")


@check("Q11", oracle("""
SELECT CAST(COUNT(*) >= 1 AS INTEGER) AS has_rows, CAST(COUNT(*) FILTER (alert_flag IS NULL) = 0 AS INTEGER) AS no_null_alert,
  CAST(COUNT(*) FILTER (shap_feature_1 IS NULL) = 0 AS INTEGER) AS no_null_attribution,
  CAST(CAST(COUNT(*) FILTER (hospital_name IS NULL) AS DOUBLE) / NULLIF(COUNT(*), 0) < 0.05 AS INTEGER) AS names_matched
FROM v_forecast WHERE run_date = DATE '2024-01-15'
""", "v_forecast"))
def forecast_checks(t: Tables) -> DataFrame:
    return Q.check_forecast(forecast_serving(V.predictions(t), V.hospitals(t)), "2024-01-15")


@check("Q12", oracle("""
SELECT CAST(COUNT(*) >= 1 AS INTEGER) AS has_rows,
  CAST(COUNT(*) FILTER (pred_occupancy_next_week IS NULL) = 0 AS INTEGER) AS no_null_predictions,
  CAST(COUNT(DISTINCT model_name) >= 1 AS INTEGER) AS has_models
FROM v_predictions WHERE run_date = DATE '2024-01-15'
""", "v_predictions"))
def observability_checks(t: Tables) -> DataFrame:
    return Q.check_observability(observability(V.predictions(t)), "2024-01-15")


@check("Q13", oracle("""
SELECT raw_rows, raw_primary_rows, raw_rows AS observed_rows, raw_primary_rows AS served_rows, TRUE AS observability_ok,
  TRUE AS serving_ok
FROM (SELECT COUNT(*) AS raw_rows, COUNT(*) FILTER (model_name = 'XGBoost') AS raw_primary_rows FROM v_predictions
  WHERE run_date = DATE '2024-01-15') g
""", "v_predictions"))
def reconciliation(t: Tables) -> DataFrame:
    raw = V.predictions(t)
    return Q.reconcile(raw, observability(raw), forecast_serving(raw, V.hospitals(t)), "2024-01-15")
