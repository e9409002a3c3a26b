"""Domain tables as views over the driver's tables, once as DataFrames and once as SQL text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardmill.checks.registry import Tables
from wardmill.functions.measures import per_100k, pct_of, ratio, metro_flag
from wardmill.plans.fact import with_rates

AS_OF = "2001-06-30"


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.withColumns({n: F.round(n, digits) for n, dt in df.dtypes if dt == "double"})


def key10(c: Column) -> Column:
    return F.lpad(c.cast("string"), 10, "0")


def weekly(t: Tables) -> DataFrame:
    """Facility-week counts. Grouped by the raw key; the text id is built from the few result rows."""
    c = F.col
    qty = c("l_quantity")

    def total(condition: Column) -> Column:
        return F.sum(F.when(condition, qty).otherwise(0.0))

    def rows(condition: Column, factor: float = 1.0) -> Column:
        return F.count_if(condition).cast("double") * factor

    icu, covid, flu = c("l_returnflag") == "R", c("l_linestatus") == "O", c("l_returnflag") == "A"
    small = qty <= 10
    grouped = t.lineitem.groupBy(
        "l_suppkey", F.trunc(c("l_shipdate").cast("date"), "week").alias("collection_week")
    ).agg(
        (F.count(F.lit(1)) * 30).cast("double").alias("inpatient_beds_capacity"),
        F.sum(qty).alias("inpatient_beds_used"),
        rows(icu, 30.0).alias("icu_beds_capacity"),
        total(icu).alias("icu_beds_used"),
        total(covid).alias("covid_hospitalized_patients"),
        total(covid & icu).alias("covid_icu_patients"),
        total(flu).alias("influenza_hospitalized_patients"),
        total(flu & (c("l_tax") > 0.04)).alias("influenza_icu_patients"),
        F.count(F.lit(1)).cast("double").alias("ed_visits_total"),
        rows(covid & (qty > 10)).alias("covid_admissions_adult"),
        rows(covid & small).alias("covid_admissions_pediatric"),
        rows(small, 10.0).alias("pediatric_beds_capacity"),
        total(small).alias("pediatric_beds_used"),
        F.bool_or(c("l_discount") > 0.09).alias("is_corrected"),
    )
    named = grouped.withColumns({
        "hospital_id": key10(c("l_suppkey")),
        "state": F.concat(F.lit("S"), (c("l_suppkey") % 7).cast("string")),
    })
    return named.drop("l_suppkey")


def fact(t: Tables) -> DataFrame:
    return with_rates(weekly(t))


def hospitals(t: Tables) -> DataFrame:
    c = F.col
    kind = F.when(c("s_nationkey") % 3 == 0, "Acute Care").when(c("s_nationkey") % 3 == 1, "Critical Access")
    return t.supplier.select(
        key10(c("s_suppkey")).alias("hospital_id"),
        c("s_name").alias("hospital_name"),
        kind.otherwise("Psychiatric").alias("hospital_type"),
        F.lpad((c("s_suppkey") % 100000).cast("string"), 5, "0").alias("zip_code"),
        F.lpad(c("s_nationkey").cast("string"), 5, "0").alias("county_fips"),
        F.concat(F.lit("S"), (c("s_suppkey") % 7).cast("string")).alias("state"),
        F.floor(F.abs(c("s_acctbal")) / 10).cast("bigint").alias("certified_bed_count"),
        (c("s_nationkey") + 0.25).cast("double").alias("latitude"),
        (c("s_nationkey") * -2.0).cast("double").alias("longitude"),
    )


def geography(t: Tables) -> DataFrame:
    c = F.col
    return t.nation.join(t.region, c("n_regionkey") == c("r_regionkey"), "left").select(
        F.lpad(c("n_nationkey").cast("string"), 5, "0").alias("county_fips"),
        c("n_name").alias("county_name"),
        c("n_regionkey").cast("string").alias("state_code"),
        c("r_name").alias("state_name"),
        c("r_name").alias("hrr_region"),
        ((c("n_nationkey") + 1) * 100).cast("double").alias("area_km2"),
    )


def customer_years(t: Tables) -> DataFrame:
    """Orders folded to one row per customer and year before they meet the customers."""
    per_year = t.orders.groupBy("o_custkey", F.year("o_orderdate").alias("census_year")).agg(
        F.count(F.lit(1)).alias("n_orders")
    )
    return t.customer.join(per_year, F.col("c_custkey") == F.col("o_custkey"), "inner")


def population(t: Tables) -> DataFrame:
    c = F.col
    people = c("total_population")
    counted = customer_years(t).groupBy("c_nationkey", "census_year").agg(
        F.count(F.lit(1)).alias("total_population"),
        F.count_if(c("c_mktsegment") == "HOUSEHOLD").alias("older"),
        F.count_if(c("c_acctbal") < 0).alias("poor"),
        F.count_if(c("c_mktsegment") == "MACHINERY").alias("uninsured"),
        F.sum("n_orders").alias("staff"),
    )
    code = (c("c_nationkey") % 9 + 1).cast("int")
    return counted.select(
        F.lpad(c("c_nationkey").cast("string"), 5, "0").alias("county_fips"),
        c("census_year").cast("int").alias("census_year"),
        people,
        pct_of(c("older"), people).alias("pop_65_plus_pct"),
        ratio(people, (c("c_nationkey") + 1) * 100, 4).alias("population_density"),
        (c("staff") * 1000).cast("double").alias("median_household_income"),
        pct_of(c("poor"), people).alias("poverty_rate_pct"),
        pct_of(c("uninsured"), people).alias("uninsured_rate_pct"),
        per_100k(c("staff"), people).alias("physicians_per_100k"),
        per_100k(c("older"), people).alias("nurses_per_100k"),
        code.alias("rucc_code"),
        metro_flag(code).alias("metro_nonmetro_flag"),
    )


def predictions(t: Tables) -> DataFrame:
    """One prediction per model, facility and run; several runs share a report week."""
    c = F.col
    model = F.when(c("event_type").isin("click", "view", "purchase"), "XGBoost").otherwise("LightGBM")
    runs = t.events.groupBy(
        model.alias("model_name"), "user_id", c("ts").cast("date").alias("run_date")
    ).agg(
        F.max("value").alias("value"),
        F.min("event_type").alias("top1_feature"),
        F.max("event_type").alias("top2_feature"),
        F.max("event_id").alias("event_id"),
    )
    actual = (c("event_id") % 101).cast("double") / 100
    prediction = F.least(F.round(c("value") / 100, 4), F.lit(1.0))
    return runs.select(
        "model_name",
        key10(c("user_id")).alias("hospital_id"),
        F.trunc("run_date", "week").alias("report_date"),
        "run_date",
        prediction.alias("pred_occupancy_next_week"),
        (c("value") > 85).cast("bigint").alias("pred_high_strain"),
        F.round(F.least(c("value") / 150, F.lit(1.0)), 4).alias("pred_high_strain_prob"),
        actual.alias("actual_occupancy"),
        (actual > 0.85).cast("bigint").alias("actual_high_strain"),
        F.round(F.abs(actual - prediction), 4).alias("abs_error"),
        F.lit(0.5).alias("shap_base_value"),
        "top1_feature",
        F.round(c("value") / 1000, 5).alias("top1_shap"),
        F.lit("up").alias("top1_direction"),
        "top2_feature",
        F.round(c("value") / -10000, 6).alias("top2_shap"),
        F.lit("down").alias("top2_direction"),
        F.lit(None).cast("string").alias("top3_feature"),
        F.lit(None).cast("double").alias("top3_shap"),
        F.lit(None).cast("string").alias("top3_direction"),
        F.concat(c("top1_feature"), F.lit(", "), c("top2_feature")).alias("explanation"),
        F.lit("v1").alias("model_version"),
        F.lit("events").alias("data_source"),
    )


def scores(t: Tables) -> DataFrame:
    c = F.col
    return t.documents.select("doc_id", "n_chars", "lang").join(t.labels, ["doc_id"], "inner").select(
        "doc_id",
        c("lang").alias("model_name"),
        c("quality").cast("double").alias("y"),
        F.least(c("n_chars") / 5000, F.lit(1.0)).alias("p"),
        c("toxic").alias("label"),
        F.least(c("n_chars") / 8000, F.lit(1.0)).alias("prob"),
    )


def bronze_utilization(t: Tables) -> DataFrame:
    c = F.col
    whole = lambda x: F.round(x).cast("bigint").cast("string")
    return t.lineitem.select(
        c("l_suppkey").cast("string").alias("hospital_pk"),
        F.concat(F.lit(" clinic "), c("l_returnflag"), F.lit(" ")).alias("hospital_name"),
        F.lower("l_linestatus").alias("state"),
        c("l_partkey").cast("string").alias("fips_code"),
        c("l_shipdate").cast("date").cast("string").alias("collection_week"),
        F.when(c("l_tax") == 0, "nan").otherwise(whole(c("l_discount") * 1000)).alias("total_beds_7_day_avg"),
        whole(c("l_quantity")).alias("inpatient_beds_used_7_day_avg"),
        whole(c("l_tax") * 1000).alias("total_staffed_adult_icu_beds_7_day_avg"),
        whole(c("l_linenumber") * 5).alias("icu_beds_used_7_day_avg"),
        F.when(c("l_linenumber") == 7, "None").otherwise(whole(c("l_linenumber") * 8))
        .alias("total_adult_patients_hospitalized_confirmed_and_suspected_covid_7_day_avg"),
    )


def bronze_facility(t: Tables) -> DataFrame:
    c = F.col
    return t.orders.select(
        c("o_custkey").cast("string").alias("PRVDR_NUM"),
        F.concat(F.lit(" "), F.lower("o_orderpriority"), F.lit(" ")).alias("FAC_NM"),
        F.lower("o_orderstatus").alias("CITY"),
        F.concat(F.lit("s"), F.lower("o_orderstatus")).alias("STATE_CD"),
        F.lpad((c("o_orderkey") % 100000).cast("string"), 5, "0").alias("ZIP_CD"),
        F.lpad((c("o_orderkey") % 1000).cast("string"), 3, "0").alias("FIPS_CNTY_CD"),
        F.when(c("o_orderstatus") == "P", "None")
        .otherwise(F.floor(c("o_totalprice") / 100).cast("string")).alias("CRTFD_BED_CNT"),
        F.substring("o_orderpriority", 1, 1).alias("FAC_TYPE_CD"),
        F.when(c("o_orderstatus") == "F", "bad").otherwise(F.date_format(c("o_orderdate").cast("date"), "yyyyMMdd"))
        .alias("CRTFCTN_DT"),
    )


# --- the same views as SQL -------------------------------------------------------------

KEY10 = "lpad(CAST({} AS VARCHAR), 10, '0')"

WEEKLY = """
SELECT lpad(CAST(l_suppkey AS VARCHAR), 10, '0') AS hospital_id,
  CAST(date_trunc('week', l_shipdate) AS DATE) AS collection_week,
  'S' || CAST(l_suppkey % 7 AS VARCHAR) AS state,
  CAST(COUNT(*) * 30 AS DOUBLE) AS inpatient_beds_capacity,
  SUM(l_quantity) AS inpatient_beds_used,
  CAST(COUNT(*) FILTER (l_returnflag = 'R') * 30 AS DOUBLE) AS icu_beds_capacity,
  COALESCE(SUM(l_quantity) FILTER (l_returnflag = 'R'), 0) AS icu_beds_used,
  COALESCE(SUM(l_quantity) FILTER (l_linestatus = 'O'), 0) AS covid_hospitalized_patients,
  COALESCE(SUM(l_quantity) FILTER (l_linestatus = 'O' AND l_returnflag = 'R'), 0) AS covid_icu_patients,
  COALESCE(SUM(l_quantity) FILTER (l_returnflag = 'A'), 0) AS influenza_hospitalized_patients,
  COALESCE(SUM(l_quantity) FILTER (l_returnflag = 'A' AND l_tax > CAST(0.04 AS DOUBLE)), 0) AS influenza_icu_patients,
  CAST(COUNT(*) AS DOUBLE) AS ed_visits_total,
  CAST(COUNT(*) FILTER (l_linestatus = 'O' AND l_quantity > 10) AS DOUBLE) AS covid_admissions_adult,
  CAST(COUNT(*) FILTER (l_linestatus = 'O' AND l_quantity <= 10) AS DOUBLE) AS covid_admissions_pediatric,
  CAST(COUNT(*) FILTER (l_quantity <= 10) * 10 AS DOUBLE) AS pediatric_beds_capacity,
  COALESCE(SUM(l_quantity) FILTER (l_quantity <= 10), 0) AS pediatric_beds_used,
  bool_or(l_discount > CAST(0.09 AS DOUBLE)) AS is_corrected
FROM lineitem GROUP BY l_suppkey, CAST(date_trunc('week', l_shipdate) AS DATE)
"""

FACT = """
SELECT *, inpatient_beds_used / NULLIF(inpatient_beds_capacity, 0) AS inpatient_occupancy_rate,
  icu_beds_used / NULLIF(icu_beds_capacity, 0) AS icu_occupancy_rate,
  inpatient_beds_used / NULLIF(inpatient_beds_capacity, 0) > CAST(0.9 AS DOUBLE) AS overload_flag
FROM v_weekly
"""

HOSPITALS = """
SELECT lpad(CAST(s_suppkey AS VARCHAR), 10, '0') AS hospital_id, s_name AS hospital_name,
  CASE s_nationkey % 3 WHEN 0 THEN 'Acute Care' WHEN 1 THEN 'Critical Access' ELSE 'Psychiatric' END AS hospital_type,
  lpad(CAST(s_suppkey % 100000 AS VARCHAR), 5, '0') AS zip_code,
  lpad(CAST(s_nationkey AS VARCHAR), 5, '0') AS county_fips,
  'S' || CAST(s_suppkey % 7 AS VARCHAR) AS state,
  CAST(floor(abs(s_acctbal) / 10) AS BIGINT) AS certified_bed_count,
  CAST(s_nationkey AS DOUBLE) + 0.25 AS latitude, CAST(s_nationkey AS DOUBLE) * -2 AS longitude
FROM supplier
"""

GEOGRAPHY = """
SELECT lpad(CAST(n_nationkey AS VARCHAR), 5, '0') AS county_fips, n_name AS county_name,
  CAST(n_regionkey AS VARCHAR) AS state_code, r_name AS state_name, r_name AS hrr_region,
  CAST((n_nationkey + 1) * 100 AS DOUBLE) AS area_km2
FROM nation LEFT JOIN region ON n_regionkey = r_regionkey
"""

POPULATION = """
SELECT lpad(CAST(c_nationkey AS VARCHAR), 5, '0') AS county_fips, CAST(census_year AS INTEGER) AS census_year,
  total_population,
  round(CAST(older AS DOUBLE) / total_population * 100, 4) AS pop_65_plus_pct,
  round(CAST(total_population AS DOUBLE) / ((c_nationkey + 1) * 100), 4) AS population_density,
  CAST(staff * 1000 AS DOUBLE) AS median_household_income,
  round(CAST(poor AS DOUBLE) / total_population * 100, 4) AS poverty_rate_pct,
  round(CAST(uninsured AS DOUBLE) / total_population * 100, 4) AS uninsured_rate_pct,
  round(CAST(staff AS DOUBLE) / total_population * 100000, 4) AS physicians_per_100k,
  round(CAST(older AS DOUBLE) / total_population * 100000, 4) AS nurses_per_100k,
  CAST(c_nationkey % 9 + 1 AS INTEGER) AS rucc_code,
  CASE WHEN c_nationkey % 9 + 1 <= 3 THEN 'Metro' ELSE 'Non-Metro' END AS metro_nonmetro_flag
FROM (
  SELECT c_nationkey, year(o_orderdate) AS census_year, COUNT(DISTINCT c_custkey) AS total_population,
    COUNT(DISTINCT c_custkey) FILTER (c_mktsegment = 'HOUSEHOLD') AS older,
    COUNT(DISTINCT c_custkey) FILTER (c_acctbal < 0) AS poor,
    COUNT(DISTINCT c_custkey) FILTER (c_mktsegment = 'MACHINERY') AS uninsured,
    COUNT(*) AS staff
  FROM customer JOIN orders ON o_custkey = c_custkey GROUP BY 1, 2) g
"""

PREDICTIONS = """
SELECT model_name, lpad(CAST(user_id AS VARCHAR), 10, '0') AS hospital_id,
  CAST(date_trunc('week', run_date) AS DATE) AS report_date, run_date,
  least(round(value / 100, 4), CAST(1 AS DOUBLE)) AS pred_occupancy_next_week,
  CAST(value > 85 AS BIGINT) AS pred_high_strain,
  round(least(value / 150, CAST(1 AS DOUBLE)), 4) AS pred_high_strain_prob,
  CAST(event_id % 101 AS DOUBLE) / 100 AS actual_occupancy,
  CAST(CAST(event_id % 101 AS DOUBLE) / 100 > CAST(0.85 AS DOUBLE) AS BIGINT) AS actual_high_strain,
  round(abs(CAST(event_id % 101 AS DOUBLE) / 100 - least(round(value / 100, 4), CAST(1 AS DOUBLE))), 4) AS abs_error,
  CAST(0.5 AS DOUBLE) AS shap_base_value, top1_feature, round(value / 1000, 5) AS top1_shap, 'up' AS top1_direction,
  top2_feature, round(value / -10000, 6) AS top2_shap, 'down' AS top2_direction,
  CAST(NULL AS VARCHAR) AS top3_feature, CAST(NULL AS DOUBLE) AS top3_shap, CAST(NULL AS VARCHAR) AS top3_direction,
  top1_feature || ', ' || top2_feature AS explanation, 'v1' AS model_version, 'events' AS data_source
FROM (
  SELECT CASE WHEN event_type IN ('click', 'view', 'purchase') THEN 'XGBoost' ELSE 'LightGBM' END AS model_name,
    user_id, CAST(ts AS DATE) AS run_date, MAX(value) AS value, MIN(event_type) AS top1_feature,
    MAX(event_type) AS top2_feature, MAX(event_id) AS event_id
  FROM events GROUP BY 1, 2, 3) e
"""

SCORES = """
SELECT d.doc_id, lang AS model_name, CAST(quality AS DOUBLE) AS y,
  least(CAST(n_chars AS DOUBLE) / 5000, CAST(1 AS DOUBLE)) AS p, toxic AS label,
  least(CAST(n_chars AS DOUBLE) / 8000, CAST(1 AS DOUBLE)) AS prob
FROM documents d JOIN labels l ON d.doc_id = l.doc_id
"""

BRONZE_UTILIZATION = """
SELECT CAST(l_suppkey AS VARCHAR) AS hospital_pk, ' clinic ' || l_returnflag || ' ' AS hospital_name,
  lower(l_linestatus) AS state, CAST(l_partkey AS VARCHAR) AS fips_code,
  CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS collection_week,
  CASE WHEN l_tax = 0 THEN NULL ELSE CAST(round(l_discount * 1000) AS DOUBLE) END AS total,
  round(l_quantity) AS used, round(l_tax * 1000) AS icu_staffed, CAST(l_linenumber * 5 AS DOUBLE) AS icu_used,
  CASE WHEN l_linenumber = 7 THEN NULL ELSE CAST(l_linenumber * 8 AS DOUBLE) END AS covid
FROM lineitem
"""

FORECAST = """
SELECT md5(concat_ws('|', p.model_name, p.hospital_id, CAST(p.report_date AS VARCHAR), CAST(p.run_date AS VARCHAR)))
    AS forecast_id,
  p.hospital_id, d.hospital_name, d.state, p.run_date, CAST(p.report_date + 7 AS DATE) AS forecast_date,
  p.pred_occupancy_next_week AS predicted_occupancy_rate,
  greatest(CAST(0 AS DOUBLE), p.pred_occupancy_next_week - CAST(0.05 AS DOUBLE)) AS confidence_lower_95,
  least(CAST(1 AS DOUBLE), p.pred_occupancy_next_week + CAST(0.05 AS DOUBLE)) AS confidence_upper_95,
  p.pred_occupancy_next_week >= CAST(0.9 AS DOUBLE) AS alert_flag,
  p.top1_feature AS shap_feature_1, p.top2_feature AS shap_feature_2, p.top3_feature AS shap_feature_3,
  p.top1_shap AS shap_value_1, p.top2_shap AS shap_value_2, p.top3_shap AS shap_value_3, p.model_version
FROM v_predictions p LEFT JOIN v_hospitals d ON p.hospital_id = d.hospital_id
WHERE p.model_name = 'XGBoost'
"""

CALENDAR = """
SELECT d AS full_date, dayname(d) AS day_of_week, CAST(week(d) AS INTEGER) AS week_number,
  CAST(month(d) AS INTEGER) AS month, CAST(quarter(d) AS INTEGER) AS quarter, CAST(year(d) AS INTEGER) AS year,
  CASE WHEN month(d) IN (12, 1, 2) THEN 'Winter' WHEN month(d) IN (3, 4, 5) THEN 'Spring'
    WHEN month(d) IN (6, 7, 8) THEN 'Summer' ELSE 'Fall' END AS season,
  FALSE AS is_holiday, (month(d) >= 10 OR month(d) <= 5) AS is_flu_season,
  CASE WHEN month(d) >= 10 OR month(d) <= 5 THEN 'Flu' ELSE 'Off' END AS disease_season,
  CASE WHEN month(d) IN (12, 1, 2) THEN 'High' WHEN month(d) IN (10, 11, 3, 4, 5) THEN 'Medium' ELSE 'Low' END
    AS healthcare_risk_level,
  CAST(ceil(day(d) / 7) AS INTEGER) AS week_of_month
FROM (SELECT CAST(unnest(generate_series(
  (SELECT MIN(CAST(l_shipdate AS DATE)) FROM lineitem), (SELECT MAX(CAST(l_shipdate AS DATE)) FROM lineitem),
  INTERVAL 1 DAY)) AS DATE) AS d) g
"""

# Every view with the views it needs first.
SQL_VIEWS = {
    "v_weekly": ((), WEEKLY),
    "v_fact": (("v_weekly",), FACT),
    "v_hospitals": ((), HOSPITALS),
    "v_geography": ((), GEOGRAPHY),
    "v_population": ((), POPULATION),
    "v_predictions": ((), PREDICTIONS),
    "v_forecast": (("v_predictions", "v_hospitals"), FORECAST),
    "v_scores": ((), SCORES),
    "v_bronze_utilization": ((), BRONZE_UTILIZATION),
    "v_calendar": ((), CALENDAR),
}


def oracle(body: str, *views: str) -> str:
    """A statement with the given views (and those they need) as common table expressions."""
    ordered: list[str] = []

    def add(name: str) -> None:
        needs, _ = SQL_VIEWS[name]
        for n in needs:
            add(n)
        if name not in ordered:
            ordered.append(name)

    for v in views:
        add(v)
    body = body.strip()
    if not ordered:
        return body
    ctes = ",\n".join(f"{v} AS ({SQL_VIEWS[v][1].strip()})" for v in ordered)
    if body.upper().startswith("WITH "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"
