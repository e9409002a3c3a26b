"""Projections, cleaning, filters and derived measures."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardmill.checks import views as V
from wardmill.checks.registry import Tables, check
from wardmill.checks.views import oracle
from wardmill.constants import STATE_BY_FIPS
from wardmill.functions import cleaning as C
from wardmill.functions import measures as M
from wardmill.functions.dates import quarter_tag, season, sunday_week, weekday_name, within_days
from wardmill.functions.keys import stable_id, surrogate_key
from wardmill.operators import shape as S
from wardmill.operators.aggregates import snapshot_quarter
from wardmill.operators.attribution import to_serving_columns
from wardmill.operators.dedup import latest_only
from wardmill.operators.panel import panel_filter
from wardmill.operators.prep import clip_target, ensure_label
from wardmill.plans.silver import census_measures
from wardmill.sources.readers import with_lineage

c = F.col


@check("SC03", """
SELECT o_orderkey, o_totalprice, 'orders' AS _source_file FROM orders
""")
def scan_with_lineage(t: Tables) -> DataFrame:
    return with_lineage(t.orders.select("o_orderkey", "o_totalprice"), "orders", V.AS_OF).drop("_ingested_at")


@check("P01 P02", """
SELECT s_suppkey AS provider_id, s_name AS facility_name, s_acctbal AS balance FROM supplier
""")
def renamed_and_kept(t: Tables) -> DataFrame:
    renamed = S.rename_existing(
        t.supplier, {"s_suppkey": "provider_id", "s_name": "facility_name", "s_acctbal": "balance", "absent": "x"}
    )
    return S.keep_existing(renamed, ["provider_id", "facility_name", "city", "balance"])


@check("P03 P04", """
SELECT c_custkey, TRY_CAST(regexp_replace(c_name, '[^0-9.\\-]', '', 'g') AS DOUBLE) AS name_number,
  TRY_CAST(regexp_replace(c_mktsegment, '[^0-9.\\-]', '', 'g') AS DOUBLE) AS segment_number,
  TRY_CAST(regexp_replace('$ ' || CAST(c_acctbal AS VARCHAR) || ' USD', '[^0-9.\\-]', '', 'g') AS DOUBLE) AS balance,
  CAST(NULL AS DOUBLE) AS absent
FROM customer
""")
def cleaned_numbers(t: Tables) -> DataFrame:
    df = t.customer.withColumn("priced", F.format_string("$ %s USD", c("c_acctbal").cast("string")))
    return df.select(
        "c_custkey",
        C.clean_numeric(df, "c_name").alias("name_number"),
        C.clean_numeric(df, "c_mktsegment").alias("segment_number"),
        C.clean_numeric(df, "priced").alias("balance"),
        C.col_or_null(df, "not_there", "double").alias("absent"),
    )


@check("P05", """
SELECT CAST(l_orderkey AS VARCHAR) AS l_orderkey, CAST(l_quantity AS BIGINT) AS l_quantity,
  CAST(l_shipdate AS DATE) AS l_shipdate, CAST(l_linenumber AS DOUBLE) AS l_linenumber
FROM lineitem
""")
def typed_projection(t: Tables) -> DataFrame:
    return S.project_typed(
        t.lineitem,
        {"l_orderkey": "string", "l_quantity": "bigint", "l_shipdate": "date", "l_linenumber": "double"},
    )


MIXED_SQL = """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN o_orderpriority ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END
  AS mixed FROM orders
"""


@check("P06 X14", f"""
SELECT o_orderkey, TRY_CAST(mixed AS DATE) AS as_date FROM ({MIXED_SQL}) m
""")
def safe_date_cast(t: Tables) -> DataFrame:
    mixed = F.when(c("o_orderstatus") == "P", c("o_orderpriority")).otherwise(
        c("o_orderdate").cast("date").cast("string")
    )
    return t.orders.select("o_orderkey", mixed.try_cast("date").alias("as_date"))


@check("P07", """
SELECT p_partkey, TRY_CAST(p_brand AS DOUBLE) AS brand_number, TRY_CAST(split_part(p_brand, '#', 2) AS BIGINT) AS brand_id,
  TRY_CAST(CAST(p_retailprice AS VARCHAR) AS DOUBLE) AS price
FROM part
""")
def coerced_numbers(t: Tables) -> DataFrame:
    return t.part.select(
        "p_partkey",
        C.to_double(c("p_brand")).alias("brand_number"),
        C.to_integer(F.split_part("p_brand", F.lit("#"), F.lit(2))).alias("brand_id"),
        C.to_double(c("p_retailprice").cast("string")).alias("price"),
    )


@check("P08 X06", """
SELECT c_custkey, trim(upper('  ' || lower(c_mktsegment) || ' ')) AS segment, trim(' ' || c_name) AS customer_name
FROM customer
""")
def normalised_text(t: Tables) -> DataFrame:
    df = t.customer.select(
        "c_custkey",
        F.concat(F.lit("  "), F.lower("c_mktsegment"), F.lit(" ")).alias("segment"),
        F.concat(F.lit(" "), c("c_name")).alias("customer_name"),
    )
    return C.with_norm_text(C.with_norm_text(df, ["segment", "absent"]), ["customer_name"], upper=False)


AREA_NAMES_SQL = """
SELECT c_custkey, c_name || CASE c_nationkey % 6 WHEN 0 THEN ' County' WHEN 1 THEN ' PARISH' WHEN 2 THEN ' borough'
  WHEN 3 THEN ' Census Area' WHEN 4 THEN ' Municipality' ELSE ' County Line' END AS area_name FROM customer
"""


def _area_names(t: Tables) -> DataFrame:
    k = c("c_nationkey") % 6
    suffix = (
        F.when(k == 0, " County").when(k == 1, " PARISH").when(k == 2, " borough").when(k == 3, " Census Area")
        .when(k == 4, " Municipality").otherwise(" County Line")
    )
    return t.customer.select("c_custkey", F.concat("c_name", suffix).alias("area_name"))


@check("P09", f"""
SELECT c_custkey, regexp_replace(area_name, '\\s+(County|Parish|Borough|Census Area|Municipality)$', '', 'i') AS short_name
FROM ({AREA_NAMES_SQL}) a
""")
def stripped_suffix(t: Tables) -> DataFrame:
    return _area_names(t).select("c_custkey", C.strip_suffix(c("area_name")).alias("short_name"))


@check("P10 X07", """
SELECT c_custkey,
  CASE WHEN c_acctbal >= 0 AND c_nationkey > 12 THEN c_name || ', Old Town' ELSE c_name END AS head,
  CASE WHEN c_acctbal >= 0 THEN c_mktsegment WHEN c_nationkey > 12 THEN 'Old Town' END AS tail
FROM customer
""")
def split_at_last_comma(t: Tables) -> DataFrame:
    text = F.concat(
        c("c_name"),
        F.when(c("c_nationkey") > 12, ", Old Town").otherwise(""),
        F.when(c("c_acctbal") >= 0, F.concat(F.lit(", "), c("c_mktsegment"))).otherwise(""),
    )
    head, tail = C.split_last(text, ", ")
    return t.customer.select("c_custkey", head.alias("head"), tail.alias("tail"))


@check("P11 P12 X05", """
SELECT c_custkey,
  COALESCE(CASE WHEN c_acctbal < 0 THEN NULL ELSE 'A' END || lpad(CAST(c_nationkey AS VARCHAR), 2, '0'),
    'B' || c_mktsegment) AS code,
  CASE WHEN length(CAST(c_custkey AS VARCHAR)) < 3 THEN lpad(CAST(c_custkey AS VARCHAR), 3, '0')
    ELSE CAST(c_custkey AS VARCHAR) END AS padded,
  lpad(CAST(c_custkey AS VARCHAR), 3, '0') AS padded_cut
FROM customer
""")
def composed_codes(t: Tables) -> DataFrame:
    first = F.when(c("c_acctbal") >= 0, "A")
    return t.customer.select(
        "c_custkey",
        C.compose_code((first, C.pad_code(c("c_nationkey"), 2)), (F.lit("B"), c("c_mktsegment"))).alias("code"),
        C.pad_code(c("c_custkey"), 3).alias("padded"),
        C.pad_code(c("c_custkey"), 3, truncate=True).alias("padded_cut"),
    )


_STATES = ", ".join(f"('{k}', '{v}')" for k, v in STATE_BY_FIPS.items())


@check("P13", f"""
SELECT c_custkey, m.abbr AS state_code
FROM customer LEFT JOIN (VALUES {_STATES}) m(code, abbr) ON lpad(CAST(c_nationkey AS VARCHAR), 2, '0') = m.code
""")
def mapped_codes(t: Tables) -> DataFrame:
    return t.customer.select(
        "c_custkey", C.map_code(C.pad_code(c("c_nationkey"), 2), STATE_BY_FIPS).alias("state_code")
    )


@check("P14", """
SELECT p_partkey, round(p_size * CAST(2.58999 AS DOUBLE), 6) AS area_km2 FROM part
""")
def square_kilometres(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", F.round(M.area_km2(c("p_size").cast("double")), 6).alias("area_km2"))


@check("P15 P16", """
SELECT o_orderkey, CAST(year(o_orderdate) AS BIGINT) AS season_start_year,
  CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(o_orderdate AS DATE) END AS week_end
FROM orders
""")
def seasons_and_dates(t: Tables) -> DataFrame:
    year = F.year("o_orderdate")
    label = F.concat(year.cast("string"), F.lit("-"), F.lpad(((year + 1) % 100).cast("string"), 2, "0"))
    text = F.when(c("o_orderstatus") == "P", "week 9").otherwise(
        F.date_format(c("o_orderdate").cast("date"), "MMM-dd-yyyy")
    )
    return t.orders.select(
        "o_orderkey",
        C.season_start(label).alias("season_start_year"),
        C.parse_date(text, "MMM-dd-yyyy").alias("week_end"),
    )


@check("P18", """
SELECT o_orderpriority, 'q' || CAST(quarter(first_date) AS VARCHAR) || '_' || CAST(year(first_date) AS VARCHAR) AS quarter
FROM (SELECT o_orderpriority, MIN(CAST(o_orderdate AS DATE)) FILTER (o_orderstatus <> 'F') AS first_date
  FROM orders GROUP BY 1) g
""")
def quarter_of_snapshot(t: Tables) -> DataFrame:
    text = F.when(c("o_orderstatus") == "F", "bad").otherwise(
        F.date_format(c("o_orderdate").cast("date"), "yyyyMMdd")
    )
    return snapshot_quarter(t.orders.select("o_orderpriority", text.alias("d")), "d", ["o_orderpriority"])


@check("P19", """
SELECT n_nationkey, 'v1.0' AS pipeline_version, TRUE AS is_active FROM nation
""")
def audited(t: Tables) -> DataFrame:
    return S.with_audit(t.nation.select("n_nationkey"), V.AS_OF).drop("processed_at")


@check("P20", """
SELECT c_custkey, COALESCE(CASE WHEN c_acctbal >= 0 THEN c_acctbal END, 0) AS balance,
  COALESCE(NULLIF(c_mktsegment, 'BUILDING'), 'Unknown') AS segment
FROM customer
""")
def default_filled(t: Tables) -> DataFrame:
    df = t.customer.select(
        "c_custkey",
        F.when(c("c_acctbal") >= 0, c("c_acctbal")).alias("balance"),
        F.nullif("c_mktsegment", F.lit("BUILDING")).alias("segment"),
    )
    return S.fill_defaults(df, {"balance": 0.0, "segment": "Unknown", "absent": 1})


@check("P21 D10 D11", oracle("""
SELECT hospital_id, collection_week, CAST(is_corrected AS INTEGER) AS corrected, overload_flag,
  CAST(icu_occupancy_rate > CAST(0.85 AS DOUBLE) AS INTEGER) AS icu_strain,
  round(inpatient_occupancy_rate, 6) AS rate
FROM v_fact
""", "v_fact"))
def flags(t: Tables) -> DataFrame:
    return V.fact(t).select(
        "hospital_id", "collection_week", M.flag(c("is_corrected")).alias("corrected"), "overload_flag",
        M.high_strain(c("icu_occupancy_rate")).alias("icu_strain"),
        F.round("inpatient_occupancy_rate", 6).alias("rate"),
    )


@check("P22", """
SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE value END AS icu_used, value AS other FROM events
""")
def sentinels_removed(t: Tables) -> DataFrame:
    df = t.events.select(
        "event_id",
        F.when(c("event_type") == "error", -9999.0).otherwise(c("value")).alias("icu_used"),
        c("value").alias("other"),
    )
    return S.null_sentinels(df, ["icu_used", "covid_icu"], -9999)


@check("P23 X23", oracle("""
SELECT CAST('0x' || substr(md5(concat_ws('_', hospital_id, CAST(collection_week AS VARCHAR))), 1, 15) AS BIGINT) AS fact_id,
  hospital_id, collection_week
FROM v_fact
""", "v_fact"))
def surrogate_keys(t: Tables) -> DataFrame:
    return V.fact(t).select(
        surrogate_key(c("hospital_id"), c("collection_week")).alias("fact_id"), "hospital_id", "collection_week"
    )


@check("P24 P25 P26", oracle("""
SELECT md5(concat_ws('|', model_name, hospital_id, CAST(report_date AS VARCHAR), CAST(run_date AS VARCHAR))) AS forecast_id,
  top1_feature AS shap_feature_1, top2_feature AS shap_feature_2, top1_shap AS shap_value_1, top2_shap AS shap_value_2
FROM v_predictions
""", "v_predictions"))
def serving_columns(t: Tables) -> DataFrame:
    served = to_serving_columns(V.predictions(t).withColumn(
        "forecast_id", stable_id(c("model_name"), c("hospital_id"), c("report_date"), c("run_date"))
    ))
    keep = ["forecast_id", "shap_feature_1", "shap_feature_2", "shap_value_1", "shap_value_2", "run_date"]
    return served.select(*keep).drop("run_date")


@check("P30 M02", oracle("""
SELECT hospital_id, collection_week, round(least(greatest(inpatient_occupancy_rate, 0), 1), 6) AS target,
  CAST(inpatient_occupancy_rate >= CAST(0.85 AS DOUBLE) AS INTEGER) AS label
FROM v_fact
""", "v_fact"))
def rebuilt_labels(t: Tables) -> DataFrame:
    df = V.fact(t).select("hospital_id", "collection_week", c("inpatient_occupancy_rate").alias("target"))
    clipped = clip_target(ensure_label(df, "target", "label"), "target")
    return clipped.withColumn("target", F.round("target", 6))


@check("SK17", """
SELECT event_id, CAST(ts AS DATE) AS run_date, TRY_CAST(event_type AS DOUBLE) AS score, CAST(NULL AS VARCHAR) AS explanation,
  CAST(user_id AS VARCHAR) AS hospital_id
FROM events
""")
def conformed_batch(t: Tables) -> DataFrame:
    df = t.events.select(
        c("user_id").alias("hospital_id"), "event_id", c("ts").cast("date").cast("string").alias("run_date"),
        c("event_type").alias("score"), "props",
    )
    return S.conform(
        df, "event_id bigint NOT NULL, run_date date, score double, explanation string, hospital_id string"
    )


@check("X22", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events
""")
def json_fields(t: Tables) -> DataFrame:
    return t.events.select("event_id", F.get_json_object("props", "$.k").try_cast("bigint").alias("k"))


@check("X08 X09 X10 X11 X12 D17", """
SELECT o_orderkey, dayname(d) AS day_name, CAST(week(d) AS INTEGER) AS iso_week, CAST(quarter(d) AS INTEGER) AS quarter,
  CAST(d - CAST(dayofweek(d) AS INTEGER) AS DATE) AS sunday, CAST(date_trunc('year', d) AS DATE) AS year_start,
  CAST(d + 7 AS DATE) AS next_week, CAST(date_diff('day', d, DATE '2002-01-01') AS INTEGER) AS age_days,
  'q' || CAST(quarter(d) AS VARCHAR) || '_' || CAST(year(d) AS VARCHAR) AS tag,
  CASE WHEN month(d) IN (12, 1, 2) THEN 'Winter' WHEN month(d) IN (3, 4, 5) THEN 'Spring'
    WHEN month(d) IN (6, 7, 8) THEN 'Summer' ELSE 'Fall' END AS season
FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders) o
""")
def calendar_functions(t: Tables) -> DataFrame:
    d = c("d")
    return t.orders.select("o_orderkey", c("o_orderdate").cast("date").alias("d")).select(
        "o_orderkey", weekday_name(d).alias("day_name"), F.weekofyear(d).alias("iso_week"),
        F.quarter(d).alias("quarter"), sunday_week(d).alias("sunday"), F.trunc(d, "year").alias("year_start"),
        M.forecast_date(d).alias("next_week"), F.datediff(F.lit("2002-01-01").cast("date"), d).alias("age_days"),
        quarter_tag(d).alias("tag"), season(d).alias("season"),
    )


@check("X21", """
SELECT l_orderkey, l_linenumber, CAST(round(l_quantity / 4) AS BIGINT) AS quarter_quantity FROM lineitem
""")
def rounded_integers(t: Tables) -> DataFrame:
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", C.round_to_integer(c("l_quantity") / 4).alias("quarter_quantity")
    )


@check("F01", """
SELECT c_custkey, c_mktsegment FROM customer WHERE lower(trim(c_mktsegment)) = 'household'
""")
def overall_rows(t: Tables) -> DataFrame:
    return S.filter_labels(
        t.customer.select("c_custkey", "c_mktsegment"), {"c_mktsegment": "Household", "absent": "Overall"}
    )


@check("F02 F10 U04", """
SELECT 'national' AS part, COUNT(*) AS n, CAST(SUM(o_orderkey) AS BIGINT) AS key_sum FROM orders
  WHERE o_orderpriority = '1-URGENT'
UNION ALL
SELECT 'other', COUNT(*), CAST(SUM(o_orderkey) AS BIGINT) FROM orders WHERE NOT (o_orderpriority = '1-URGENT')
UNION ALL
SELECT 'valid', COUNT(*), CAST(SUM(o_orderkey) AS BIGINT) FROM orders
  WHERE o_orderstatus <> 'P' AND o_totalprice > 200000
UNION ALL
SELECT 'invalid', COUNT(*), CAST(SUM(o_orderkey) AS BIGINT) FROM orders
  WHERE NOT (o_orderstatus <> 'P' AND o_totalprice > 200000)
""")
def split_rows(t: Tables) -> DataFrame:
    national, other = S.split_valid(t.orders, c("o_orderpriority") == "1-URGENT")
    status = F.nullif("o_orderstatus", F.lit("P"))
    valid, invalid = S.split_valid(t.orders, status.isin("O", "F") & (c("o_totalprice") > 200000))
    parts = {"national": national, "other": other, "valid": valid, "invalid": invalid}
    return S.stack([
        df.agg(F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("key_sum"))
        .select(F.lit(name).alias("part"), "n", "key_sum")
        for name, df in parts.items()
    ])


@check("F03", """
SELECT code, n FROM (
  SELECT CASE WHEN c_acctbal < 0 THEN NULL ELSE lpad(CAST(c_nationkey AS VARCHAR), CASE WHEN c_mktsegment = 'BUILDING'
    THEN 4 ELSE 5 END, '0') END AS code, COUNT(*) AS n FROM customer GROUP BY 1) g
WHERE code IS NOT NULL AND regexp_full_match(code, '[0-9]{5}')
""")
def valid_county_codes(t: Tables) -> DataFrame:
    width4 = F.lpad(c("c_nationkey").cast("string"), 4, "0")
    width5 = F.lpad(c("c_nationkey").cast("string"), 5, "0")
    code = F.when(c("c_acctbal") >= 0, F.when(c("c_mktsegment") == "BUILDING", width4).otherwise(width5))
    return S.valid_codes(t.customer.select(code.alias("code")), "code").groupBy("code").agg(
        F.count(F.lit(1)).alias("n")
    )


@check("F04", oracle("""
SELECT hospital_id, collection_week, icu_beds_capacity FROM v_fact
WHERE icu_beds_capacity > 0 AND collection_week BETWEEN DATE '1996-01-01' AND DATE '2000-12-31'
""", "v_fact"))
def panel_range(t: Tables) -> DataFrame:
    kept = panel_filter(V.fact(t), "icu_beds_capacity", "collection_week", "1996-01-01", "2000-12-31")
    return kept.select("hospital_id", "collection_week", "icu_beds_capacity")


@check("F05 F06 I03", """
SELECT 7 AS days, COUNT(*) AS n, SUM(l_quantity) AS quantity FROM lineitem
  WHERE CAST(l_shipdate AS DATE) BETWEEN DATE '2001-06-30' - 7 AND DATE '2001-06-30'
UNION ALL
SELECT 28, COUNT(*), SUM(l_quantity) FROM lineitem
  WHERE CAST(l_shipdate AS DATE) BETWEEN DATE '2001-06-30' - 28 AND DATE '2001-06-30'
""")
def trailing_windows(t: Tables) -> DataFrame:
    rows = t.lineitem.select(c("l_shipdate").cast("date").alias("d"), "l_quantity")
    return S.stack([
        rows.filter(within_days(c("d"), V.AS_OF, days))
        .agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("quantity"))
        .select(F.lit(days).alias("days"), "n", "quantity")
        for days in (7, 28)
    ])


@check("F07 J10", oracle("""
SELECT hospital_id, collection_week, inpatient_beds_used FROM v_fact
WHERE collection_week = (SELECT MAX(collection_week) FROM v_fact)
""", "v_fact"))
def newest_week(t: Tables) -> DataFrame:
    return latest_only(V.fact(t), "collection_week").select("hospital_id", "collection_week", "inpatient_beds_used")


@check("F08", """
SELECT p_partkey, p_name FROM part WHERE lower(p_name) LIKE lower('%RiNg%')
""")
def searched_names(t: Tables) -> DataFrame:
    return S.name_search(t.part.select("p_partkey", "p_name"), "p_name", "RiNg")


@check("F09", oracle("""
SELECT model_name, hospital_id, report_date, run_date, pred_occupancy_next_week FROM v_predictions
WHERE model_name = 'XGBoost' AND run_date = (SELECT MAX(run_date) FROM v_predictions)
""", "v_predictions"))
def primary_model_rows(t: Tables) -> DataFrame:
    p = V.predictions(t)
    return latest_only(p, "run_date").filter(c("model_name") == "XGBoost").select(
        "model_name", "hospital_id", "report_date", "run_date", "pred_occupancy_next_week"
    )


@check("D01 D02 D09 D16 D18 X01 X02 X16", oracle("""
SELECT hospital_id, collection_week, round(inpatient_beds_used / inpatient_beds_capacity * 100, 2) AS occupancy_rate,
  CASE WHEN icu_beds_capacity > 0 THEN round(icu_beds_used / icu_beds_capacity * 100, 2) END AS icu_rate,
  inpatient_beds_used AS total_patients, inpatient_beds_capacity - inpatient_beds_used AS available_beds,
  icu_beds_capacity - icu_beds_used AS available_icu_beds, round(inpatient_occupancy_rate * 100, 1) AS occupancy_pct,
  CASE WHEN icu_occupancy_rate >= CAST(0.9 AS DOUBLE) THEN 'CRITICAL'
    WHEN icu_occupancy_rate >= CAST(0.7 AS DOUBLE) THEN 'WARNING' ELSE 'NORMAL' END AS icu_status
FROM v_fact
""", "v_fact"))
def occupancy_measures(t: Tables) -> DataFrame:
    return V.fact(t).select(
        "hospital_id", "collection_week",
        M.occupancy_pct(c("inpatient_beds_used"), c("inpatient_beds_capacity")).alias("occupancy_rate"),
        M.occupancy_pct(c("icu_beds_used"), c("icu_beds_capacity")).alias("icu_rate"),
        c("inpatient_beds_used").alias("total_patients"),
        M.available(c("inpatient_beds_capacity"), c("inpatient_beds_used")).alias("available_beds"),
        M.available(c("icu_beds_capacity"), c("icu_beds_used")).alias("available_icu_beds"),
        M.as_pct(c("inpatient_occupancy_rate")).alias("occupancy_pct"),
        M.status_label(c("icu_occupancy_rate")).alias("icu_status"),
    )


CENSUS_SQL = """
SELECT lpad(CAST(c_nationkey AS VARCHAR), 5, '0') AS county_fips, CAST(year(o_orderdate) AS INTEGER) AS census_year,
  COUNT(*) AS people, COUNT(*) FILTER (o_orderpriority = '1-URGENT') AS band_a,
  COUNT(*) FILTER (o_orderpriority = '2-HIGH') AS band_b, COUNT(*) FILTER (o_orderstatus = 'P') AS poor,
  COUNT(*) FILTER (o_orderstatus <> 'O') AS universe, SUM(o_totalprice) AS income
FROM customer JOIN orders ON o_custkey = c_custkey GROUP BY 1, 2
"""


def census_counts(t: Tables) -> DataFrame:
    """Order counts per nation and year in the columns of a census extract."""
    orders = t.orders.groupBy("o_custkey", F.year("o_orderdate").alias("census_year")).agg(
        F.count(F.lit(1)).alias("people"),
        F.count_if(c("o_orderpriority") == "1-URGENT").alias("band_a"),
        F.count_if(c("o_orderpriority") == "2-HIGH").alias("band_b"),
        F.count_if(c("o_orderstatus") == "P").alias("poor"),
        F.count_if(c("o_orderstatus") != "O").alias("universe"),
    )
    joined = t.customer.select("c_custkey", "c_nationkey").join(orders, c("c_custkey") == c("o_custkey"))
    totals = joined.groupBy("c_nationkey", "census_year").agg(
        *[F.sum(n).alias(n) for n in ("people", "band_a", "band_b", "poor", "universe")]
    )
    return totals.select(
        F.lpad(c("c_nationkey").cast("string"), 5, "0").alias("county_fips"),
        "census_year",
        c("people").cast("double").alias("total_population_raw"),
        (c("people") * 100).cast("double").alias("median_household_income_raw"),
        c("poor").cast("double").alias("pop_below_poverty_raw"),
        c("universe").cast("double").alias("poverty_universe_raw"),
        c("band_a").cast("double").alias("uninsured_19_64_raw"),
        c("band_b").cast("double").alias("uninsured_65_plus_raw"),
        c("universe").cast("double").alias("insurance_universe_raw"),
        c("band_a").cast("double").alias("age_raw_B01001_020E"),
        c("band_b").cast("double").alias("age_raw_B01001_044E"),
    )


@check("D03 D04", f"""
SELECT county_fips, census_year, people AS total_population,
  round(CAST(band_a + band_b AS DOUBLE) / people * 100, 4) AS pop_65_plus_pct,
  CAST(people * 100 AS DOUBLE) AS median_household_income,
  CASE WHEN universe > 0 THEN round(CAST(poor AS DOUBLE) / universe * 100, 4) END AS poverty_rate_pct,
  CASE WHEN universe > 0 THEN round(CAST(band_a + band_b AS DOUBLE) / universe * 100, 4) END AS uninsured_rate_pct
FROM ({CENSUS_SQL}) g
""")
def census_rates(t: Tables) -> DataFrame:
    return census_measures(census_counts(t))


@check("D05 D06", oracle("""
SELECT p.county_fips, census_year, round(CAST(total_population AS DOUBLE) / area_km2, 4) AS density,
  round(CAST(rucc_code AS DOUBLE) / total_population * 100000, 4) AS rate_100k
FROM v_population p JOIN v_geography g ON p.county_fips = g.county_fips
""", "v_population", "v_geography"))
def county_rates(t: Tables) -> DataFrame:
    joined = V.population(t).join(V.geography(t).select("county_fips", "area_km2"), ["county_fips"])
    return joined.select(
        "county_fips", "census_year", M.ratio(c("total_population"), c("area_km2"), 4).alias("density"),
        M.per_100k(c("rucc_code"), c("total_population")).alias("rate_100k"),
    )


@check("D12 D13 D14 D15 X03 X04", oracle("""
SELECT model_name, hospital_id, report_date, run_date, CAST(report_date + 7 AS DATE) AS forecast_date,
  round(greatest(CAST(0 AS DOUBLE), pred_occupancy_next_week - CAST(0.05 AS DOUBLE)), 6) AS lower_95,
  round(least(CAST(1 AS DOUBLE), pred_occupancy_next_week + CAST(0.05 AS DOUBLE)), 6) AS upper_95,
  pred_occupancy_next_week >= CAST(0.9 AS DOUBLE) AS alert, pred_occupancy_next_week > CAST(0.9 AS DOUBLE) AS alert_strict,
  round(abs(actual_occupancy - pred_occupancy_next_week), 4) AS abs_error
FROM v_predictions
""", "v_predictions"))
def forecast_intervals(t: Tables) -> DataFrame:
    p = c("pred_occupancy_next_week")
    lower, upper = M.interval(p)
    return V.predictions(t).select(
        "model_name", "hospital_id", "report_date", "run_date", M.forecast_date(c("report_date")).alias("forecast_date"),
        F.round(lower, 6).alias("lower_95"), F.round(upper, 6).alias("upper_95"),
        M.alert_flag(p).alias("alert"), M.alert_flag(p, inclusive=False).alias("alert_strict"),
        M.abs_error(c("actual_occupancy"), p).alias("abs_error"),
    )
