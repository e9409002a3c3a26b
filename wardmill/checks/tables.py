"""Joins, deduplication, incremental forms and the dimension and silver builds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardmill.checks import views as V
from wardmill.checks.columns import CENSUS_SQL, census_counts
from wardmill.checks.registry import Tables, check
from wardmill.checks.views import oracle
from wardmill.checks.views import rounded as _rounded
from wardmill.functions.cleaning import pad_code
from wardmill.operators import aggregates as A
from wardmill.operators import incremental as I
from wardmill.operators.dedup import keep_first, keep_latest, latest_snapshot
from wardmill.operators.shape import pivot_first, stack, top_n
from wardmill.operators.skew import hot_key_left_join
from wardmill.plans import bronze as B
from wardmill.plans import dimensions as D
from wardmill.plans import silver as SV
from wardmill.plans.fact import stage_fact
from wardmill.session import staging_path
from wardmill.sources.text_formats import rows_from_json_matrix

c = F.col


# --- joins ---------------------------------------------------------------------------


@check("J02", """
SELECT a.o_custkey, a.y AS order_year, a.n_orders, b.n_urgent
FROM (SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS y, COUNT(*) AS n_orders FROM orders GROUP BY 1, 2) a
LEFT JOIN (SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS y, COUNT(*) AS n_urgent FROM orders
  WHERE o_orderpriority = '1-URGENT' GROUP BY 1, 2) b ON a.o_custkey = b.o_custkey AND a.y = b.y
""")
def composite_key_join(t: Tables) -> DataFrame:
    keys = ["o_custkey", "order_year"]
    rows = t.orders.select("o_custkey", F.year("o_orderdate").alias("order_year"), "o_orderpriority")
    every = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_orders"))
    urgent = rows.filter(c("o_orderpriority") == "1-URGENT").groupBy(*keys).agg(F.count(F.lit(1)).alias("n_urgent"))
    return every.join(urgent, keys, "left")


@check("J03 J05", """
SELECT s_suppkey, s_name, n_name, r_name FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey
LEFT JOIN region ON n_regionkey = r_regionkey
""")
def small_dimension_joins(t: Tables) -> DataFrame:
    return (
        t.supplier.join(t.nation, c("s_nationkey") == c("n_nationkey"), "left")
        .join(t.region, c("n_regionkey") == c("r_regionkey"), "left")
        .select("s_suppkey", "s_name", "n_name", "r_name")
    )


@check("J05 J07", """
SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice, p_name, p_size FROM lineitem LEFT JOIN part ON l_partkey = p_partkey
""")
def hot_key_join(t: Tables) -> DataFrame:
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    parts = t.part.select(c("p_partkey").alias("l_partkey"), "p_name", "p_size")
    return hot_key_left_join(rows, parts, ["l_partkey"])


@check("J04", oracle("""
SELECT hospital_id, collection_week, week_number, season, is_flu_season, week_of_month
FROM v_weekly LEFT JOIN v_calendar ON collection_week = full_date
""", "v_weekly", "v_calendar"))
def calendar_join(t: Tables) -> DataFrame:
    dates = D.dim_date_of(t.lineitem, "l_shipdate").select(
        c("full_date").alias("collection_week"), "week_number", "season", "is_flu_season", "week_of_month"
    )
    return V.weekly(t).select("hospital_id", "collection_week").join(dates, ["collection_week"], "left")


@check("J11", """
SELECT 'with orders' AS part, COUNT(*) AS n FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders)
UNION ALL
SELECT 'without orders', COUNT(*) FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)
""")
def semi_and_anti(t: Tables) -> DataFrame:
    match = c("c_custkey") == c("o_custkey")
    buyers = t.orders.select("o_custkey").distinct()
    parts = {"with orders": t.customer.join(buyers, match, "left_semi"),
             "without orders": t.customer.join(buyers, match, "left_anti")}
    return stack([
        df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("part"), "n") for name, df in parts.items()
    ])


# --- aggregates ------------------------------------------------------------------------


@check("A01", """
SELECT o_orderpriority AS state_name, CAST(year(o_orderdate) AS BIGINT) AS season_start_year,
  round(AVG(o_totalprice), 2) AS avg_level, MAX(o_totalprice) AS peak_level
FROM orders GROUP BY 1, 2
""")
def activity_by_season(t: Tables) -> DataFrame:
    rows = t.orders.select(
        c("o_orderpriority").alias("state_name"), F.year("o_orderdate").cast("bigint").alias("season_start_year"),
        "o_totalprice",
    )
    result = A.activity_by_season(rows, ["state_name", "season_start_year"], "o_totalprice")
    return result.withColumn("avg_level", F.round("avg_level", 2))


@check("A02 S03", """
SELECT l_suppkey, l_returnflag, l_linestatus, total_weight FROM (
  SELECT l_suppkey, l_returnflag, l_linestatus, SUM(l_quantity) AS total_weight,
    ROW_NUMBER() OVER (PARTITION BY l_suppkey ORDER BY SUM(l_quantity) DESC, l_returnflag, l_linestatus) AS rn
  FROM lineitem GROUP BY 1, 2, 3) g WHERE rn = 1
""")
def plurality_vote(t: Tables) -> DataFrame:
    return A.plurality(t.lineitem, "l_suppkey", ["l_returnflag", "l_linestatus"], "l_quantity")


@check("A03", """
SELECT o_custkey, MIN(CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END) AS "F",
  MIN(CASE WHEN o_orderstatus = 'O' THEN o_orderpriority END) AS "O",
  MIN(CASE WHEN o_orderstatus = 'P' THEN o_orderpriority END) AS "P"
FROM orders GROUP BY 1
""")
def pivoted(t: Tables) -> DataFrame:
    return pivot_first(t.orders, ["o_custkey"], "o_orderstatus", "o_orderpriority", ["F", "O", "P"])


@check("A05 SC16", oracle("""
SELECT CAST(year(collection_week) AS INTEGER) AS year, COUNT(*) AS n_rows, MIN(collection_week) AS first_date, MAX(collection_week) AS last_date,
  COUNT(DISTINCT hospital_id) AS n_entities, TRUE AS sketch_agrees, TRUE AS ranks_agree FROM v_fact GROUP BY 1
""", "v_fact"))
def profile_of_stored_weeks(t: Tables) -> DataFrame:
    """Weekly states are stored, then merged by year without the rows; sketches are judged by their stated errors."""
    path, fact = staging_path(t.spark, "profile"), V.fact(t).select("hospital_id", "collection_week", "inpatient_occupancy_rate")
    A.profile_state(fact, "hospital_id", "collection_week", "inpatient_occupancy_rate").write.parquet(path)
    states = t.spark.read.parquet(path).withColumn("year", F.year("period"))
    merged = A.profile_of(A.merged_profile(states, "year"), [0.5])
    rows = fact.withColumn("year", F.year("collection_week")).join(merged.select("year", c("quantiles")[0].alias("median")), "year")
    exact = rows.groupBy("year").agg(F.countDistinct("hospital_id").alias("exact"), F.avg((c("inpatient_occupancy_rate") <= c("median")).cast("int")).alias("up_to"),
                                     F.avg((c("inpatient_occupancy_rate") < c("median")).cast("int")).alias("below"))
    found = merged.join(exact, "year")
    return found.select("year", "n_rows", "first_date", "last_date", c("exact").alias("n_entities"),
                        (F.abs(c("n_entities") - c("exact")) <= 0.08 * c("exact")).alias("sketch_agrees"),
                        ((c("up_to") >= 0.5 - 0.03) & (c("below") <= 0.5 + 0.03)).alias("ranks_agree"))


@check("A05 SC16", oracle("""
SELECT COUNT(*) AS n_rows, COUNT(DISTINCT hospital_id) AS n_entities, MIN(collection_week) AS first_date,
  MAX(collection_week) AS last_date FROM v_fact
""", "v_fact"))
def panel_profile(t: Tables) -> DataFrame:
    return A.profile(V.fact(t), "hospital_id", "collection_week")


@check("A06 U02", oracle("""
SELECT model_name, COUNT(*) AS n FROM v_predictions GROUP BY 1
""", "v_predictions"))
def rows_per_model(t: Tables) -> DataFrame:
    p = V.predictions(t)
    models = [p.filter(c("model_name") == m) for m in ("XGBoost", "LightGBM")]
    return A.count_by(stack(models), "model_name")


@check("A11 Q16", """
SELECT total_keys, mapped_keys, round(CAST(total_keys - mapped_keys AS DOUBLE) / total_keys, 6) AS unmapped_rate,
  CAST(total_keys - mapped_keys AS DOUBLE) / total_keys <= 0.05 AS coverage_ok
FROM (SELECT (SELECT COUNT(DISTINCT user_id) FROM events) AS total_keys,
  (SELECT COUNT(DISTINCT user_id) FROM events WHERE user_id IN (SELECT s_suppkey FROM supplier)) AS mapped_keys) g
""")
def key_coverage(t: Tables) -> DataFrame:
    suppliers = t.supplier.select(c("s_suppkey").alias("user_id"))
    events = t.events.select("user_id")
    result = A.coverage(events, events.join(suppliers, ["user_id"], "left_semi"), "user_id")
    return result.withColumn("unmapped_rate", F.round("unmapped_rate", 6))


# --- one row per key ---------------------------------------------------------------------


@check("W01 S01", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, CAST(l_shipdate AS DATE) AS l_shipdate FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY CAST(l_shipdate AS DATE) DESC NULLS LAST, l_partkey DESC, l_suppkey DESC, l_quantity DESC) AS rn
  FROM lineitem) g WHERE rn = 1
""")
def latest_line_per_key(t: Tables) -> DataFrame:
    rows = t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
        c("l_shipdate").cast("date").alias("l_shipdate"),
    )
    return keep_latest(rows, ["l_orderkey", "l_linenumber"], "l_shipdate")


@check("W02", """
SELECT o_custkey, order_year, o_orderkey, o_totalprice FROM (
  SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS order_year, o_orderkey, o_totalprice,
    ROW_NUMBER() OVER (PARTITION BY o_custkey, year(o_orderdate) ORDER BY o_orderkey DESC, o_totalprice DESC) AS rn
  FROM orders) g WHERE rn = 1
""")
def newest_order_per_year(t: Tables) -> DataFrame:
    rows = t.orders.select("o_custkey", F.year("o_orderdate").alias("order_year"), "o_orderkey", "o_totalprice")
    return keep_latest(rows, ["o_custkey", "order_year"], "o_orderkey")


@check("W05", oracle("""
SELECT hospital_id, collection_week, inpatient_beds_used FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY hospital_id ORDER BY collection_week DESC) AS rn FROM v_fact
  WHERE collection_week BETWEEN DATE '2001-06-30' - 40 AND DATE '2001-06-30') g WHERE rn = 1
""", "v_fact"))
def snapshot_in_lookback(t: Tables) -> DataFrame:
    rows = V.fact(t).select("hospital_id", "collection_week", "inpatient_beds_used")
    return latest_snapshot(rows, "hospital_id", "collection_week", V.AS_OF, 40)


@check("W06", """
SELECT user_id, event_id, event_type FROM (
  SELECT user_id, event_id, event_type, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY event_id) AS rn FROM events) g
WHERE rn = 1
""")
def first_event_per_user(t: Tables) -> DataFrame:
    return keep_first(t.events.select("user_id", "event_id", "event_type"), ["user_id"], [c("event_id").asc()])


@check("S02 S05", """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100
""")
def largest_orders(t: Tables) -> DataFrame:
    return top_n(t.orders.select("o_orderkey", "o_totalprice"), [c("o_totalprice").desc(), c("o_orderkey")], 100)


@check("U01", """
SELECT CAST(year(o_orderdate) AS INTEGER) AS census_year, COUNT(*) AS n, round(SUM(o_totalprice), 2) AS total
FROM (SELECT o_orderdate, o_totalprice FROM orders UNION ALL SELECT l_shipdate, l_extendedprice FROM lineitem) x GROUP BY 1
""")
def stacked_years(t: Tables) -> DataFrame:
    """Two sources, one after the other by name; years come from the data."""
    orders = t.orders.select(F.year("o_orderdate").alias("census_year"), c("o_totalprice").alias("amount"))
    lines = t.lineitem.select(c("l_extendedprice").alias("amount"), F.year("l_shipdate").alias("census_year"))
    return stack([orders, lines]).groupBy("census_year").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("amount"), 2).alias("total"))


# --- incremental forms -----------------------------------------------------------------------

OLD_ORDERS = "SELECT o_orderkey, o_totalprice, CAST(o_orderdate AS DATE) AS d FROM orders WHERE o_orderdate < '2000-01-01'"
NEW_ORDERS = """SELECT o_orderkey, o_totalprice + 1 AS o_totalprice, CAST(o_orderdate AS DATE) AS d FROM orders
  WHERE o_orderdate >= '1998-07-01'"""


def _old_and_new(t: Tables) -> tuple[DataFrame, DataFrame]:
    rows = t.orders.select("o_orderkey", "o_totalprice", c("o_orderdate").cast("date").alias("d"))
    target = rows.filter(c("d") < F.lit("2000-01-01").cast("date"))
    source = rows.filter(c("d") >= F.lit("1998-07-01").cast("date"))
    return target, source.withColumn("o_totalprice", c("o_totalprice") + 1)


@check("SK10 J11", f"""
WITH old AS ({OLD_ORDERS}), new AS ({NEW_ORDERS})
SELECT o_orderkey, round(o_totalprice, 2) AS o_totalprice, d FROM old WHERE o_orderkey NOT IN (SELECT o_orderkey FROM new)
UNION ALL SELECT o_orderkey, round(o_totalprice, 2), d FROM new
""")
def upserted(t: Tables) -> DataFrame:
    target, source = _old_and_new(t)
    return _rounded(I.merge_upsert(target, source, ["o_orderkey"]), 2)


@check("SK11 I03", f"""
WITH old AS ({OLD_ORDERS}), new AS ({NEW_ORDERS})
SELECT o_orderkey, round(o_totalprice, 2) AS o_totalprice, d FROM old
WHERE d < DATE '1999-01-01' OR o_orderkey NOT IN (SELECT o_orderkey FROM new)
UNION ALL SELECT o_orderkey, round(o_totalprice, 2), d FROM new
""")
def upserted_since(t: Tables) -> DataFrame:
    target, source = _old_and_new(t)
    return _rounded(I.merge_upsert(target, source, ["o_orderkey"], since="1999-01-01", on="d"), 2)


@check("SK12 I01", f"""
WITH old AS ({OLD_ORDERS}), new AS ({NEW_ORDERS})
SELECT o_orderkey, round(o_totalprice, 2) AS o_totalprice, d FROM old
UNION ALL SELECT o_orderkey, round(o_totalprice, 2), d FROM new
  WHERE d > (SELECT COALESCE(MAX(d), DATE '1900-01-01') FROM old)
""")
def appended_since_mark(t: Tables) -> DataFrame:
    target, source = _old_and_new(t)
    return _rounded(I.append_since(target, source, "d"), 2)


@check("SK13", oracle("""
SELECT model_name, hospital_id, run_date, pred_occupancy_next_week FROM v_predictions
WHERE run_date <> DATE '2024-01-10'
UNION ALL
SELECT model_name, hospital_id, run_date, round(pred_occupancy_next_week / 2, 6) FROM v_predictions
WHERE run_date = DATE '2024-01-10'
""", "v_predictions"))
def replaced_run(t: Tables) -> DataFrame:
    rows = V.predictions(t).select("model_name", "hospital_id", "run_date", "pred_occupancy_next_week")
    batch = rows.filter(c("run_date") == F.lit("2024-01-10").cast("date"))
    batch = batch.withColumn("pred_occupancy_next_week", F.round(c("pred_occupancy_next_week") / 2, 6))
    return I.replace_run(rows, batch, "run_date", "2024-01-10")


@check("I02", f"""
WITH old AS ({OLD_ORDERS}), new AS ({NEW_ORDERS}),
late AS (SELECT * FROM new WHERE d >= (SELECT MAX(d) - 3 FROM old))
SELECT o_orderkey, round(o_totalprice, 2) AS o_totalprice, d FROM old WHERE o_orderkey NOT IN (SELECT o_orderkey FROM late)
UNION ALL SELECT o_orderkey, round(o_totalprice, 2), d FROM late
""")
def late_rows_upserted(t: Tables) -> DataFrame:
    target, source = _old_and_new(t)
    return _rounded(I.incremental_upsert(target, source, "d", 3, ["o_orderkey"]), 2)


@check("I04", """
SELECT newest_feature, newest_processed, newest_feature IS NOT NULL AND
  (newest_processed IS NULL OR newest_feature > newest_processed) AS has_new_data
FROM (SELECT (SELECT MAX(CAST(o_orderdate AS DATE)) FROM orders WHERE CAST(o_orderdate AS DATE) <= DATE '2001-06-30')
    AS newest_feature,
  (SELECT MAX(CAST(l_shipdate AS DATE)) FROM lineitem WHERE CAST(l_shipdate AS DATE) < DATE '2001-06-30')
    AS newest_processed) g
""")
def new_data_check(t: Tables) -> DataFrame:
    features = t.orders.select(c("o_orderdate").cast("date").alias("report_date"))
    shipped = c("l_shipdate").cast("date")
    processed = t.lineitem.select(shipped.alias("report_date"), shipped.alias("run_date"))
    return I.has_new_data(features, processed, V.AS_OF)


@check("I05", """
SELECT CAST(COUNT(*) > 0 AS INTEGER) AS has_data,
  CAST(date_diff('day', MAX(CAST(l_shipdate AS DATE)), DATE '2001-06-30') <= 40 AS INTEGER) AS data_not_stale
FROM lineitem WHERE CAST(l_shipdate AS DATE) <= DATE '2001-06-30'
""")
def freshness_check(t: Tables) -> DataFrame:
    return I.freshness(t.lineitem.select(c("l_shipdate").cast("date").alias("d")), "d", V.AS_OF)


# --- silver and dimension builds ----------------------------------------------------------------


@check("B01", """
SELECT provider_id, facility_name, city, state, zip_code, fips_county_code, certified_bed_count, facility_type_code FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY provider_id ORDER BY d DESC NULLS LAST, facility_name DESC, city DESC,
    state DESC, zip_code DESC, fips_county_code DESC, certified_bed_count DESC NULLS LAST, facility_type_code DESC) AS rn
  FROM (SELECT CAST(o_custkey AS VARCHAR) AS provider_id, upper(o_orderpriority) AS facility_name,
      upper(o_orderstatus) AS city, 'S' || upper(o_orderstatus) AS state,
      lpad(CAST(o_orderkey % 100000 AS VARCHAR), 5, '0') AS zip_code,
      lpad(CAST(o_orderkey % 1000 AS VARCHAR), 3, '0') AS fips_county_code,
      CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(floor(o_totalprice / 100) AS INTEGER) END AS certified_bed_count,
      substr(o_orderpriority, 1, 1) AS facility_type_code,
      CASE WHEN o_orderstatus <> 'F' THEN strftime(o_orderdate, '%Y%m%d') ELSE 'bad' END AS d
    FROM orders) b) r WHERE rn = 1
""")
def facility_silver(t: Tables) -> DataFrame:
    return SV.silver_facility(V.bronze_facility(t), order=[c("CRTFCTN_DT").desc_nulls_last()])


SILVER_UTILIZATION = """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY provider_id, report_date ORDER BY facility_name DESC, state DESC,
    fips_county_code DESC, inpatient_beds_total DESC NULLS LAST, inpatient_beds_used DESC, icu_beds_staffed DESC,
    icu_beds_used DESC, covid_patients DESC NULLS LAST) AS rn
  FROM (SELECT hospital_pk AS provider_id, trim(upper(hospital_name)) AS facility_name, upper(state) AS state,
      fips_code AS fips_county_code, CAST(collection_week AS DATE) AS report_date, total AS inpatient_beds_total,
      used AS inpatient_beds_used, icu_staffed AS icu_beds_staffed, icu_used AS icu_beds_used,
      CASE WHEN total > 0 THEN round(used / total * 100, 2) END AS occupancy_rate, covid AS covid_patients,
      used AS total_patients
    FROM v_bronze_utilization) b) r WHERE rn = 1
"""


@check("B02", oracle(SILVER_UTILIZATION, "v_bronze_utilization"))
def utilization_silver(t: Tables) -> DataFrame:
    return SV.silver_utilization(V.bronze_utilization(t))


def county_sources(t: Tables) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Customers as counties, suppliers as areas, parts as regions; keys overlap only partly."""
    names = t.customer.select(
        F.when(c("c_acctbal") > 9000, F.lit("12x45")).otherwise(pad_code(c("c_custkey"), 5)).alias("county_fips"),
        F.concat("c_name", F.lit(" County")).alias("county_name"),
        F.nullif("c_mktsegment", F.lit("BUILDING")).alias("state_code"),
        c("c_mktsegment").alias("state_name"),
    )
    area = t.supplier.select(
        pad_code(c("s_suppkey"), 5).alias("county_fips"), c("s_acctbal").alias("area_km2")
    )
    region = t.part.select(pad_code(c("p_partkey"), 5).alias("county_fips"), c("p_brand").alias("hrr_region"))
    return names, area, region


GEOGRAPHY_SILVER = """
SELECT county_fips, county_name, state_code, state_name, hrr_region, area_km2, NOT ok AS _has_violation,
  CASE WHEN ok THEN NULL ELSE 'DQ_FAIL: Invalid FIPS or missing state_code' END AS error_reason
FROM (SELECT n.*, hrr_region, area_km2, regexp_full_match(n.county_fips, '[0-9]{5}') AND state_code IS NOT NULL AS ok
  FROM (SELECT CASE WHEN c_acctbal > 9000 THEN '12x45' WHEN length(CAST(c_custkey AS VARCHAR)) < 5
      THEN lpad(CAST(c_custkey AS VARCHAR), 5, '0') ELSE CAST(c_custkey AS VARCHAR) END AS county_fips,
      c_name AS county_name, NULLIF(c_mktsegment, 'BUILDING') AS state_code, c_mktsegment AS state_name FROM customer) n
  LEFT JOIN (SELECT lpad(CAST(s_suppkey AS VARCHAR), 5, '0') AS county_fips, s_acctbal AS area_km2 FROM supplier) a
    ON n.county_fips = a.county_fips
  LEFT JOIN (SELECT CASE WHEN length(CAST(p_partkey AS VARCHAR)) < 5 THEN lpad(CAST(p_partkey AS VARCHAR), 5, '0')
      ELSE CAST(p_partkey AS VARCHAR) END AS county_fips, p_brand AS hrr_region FROM part) r
    ON n.county_fips = r.county_fips) j
"""


@check("B03 J01 Q04 F10", GEOGRAPHY_SILVER)
def geography_silver(t: Tables) -> DataFrame:
    return SV.silver_geography(*county_sources(t))


@check("B03", f"""
SELECT county_fips, county_name, trim(upper(state_code)) AS state_code, state_name,
  COALESCE(hrr_region, 'Unknown') AS hrr_region, COALESCE(area_km2, 0) AS area_km2, TRUE AS is_active
FROM ({GEOGRAPHY_SILVER}) s WHERE NOT _has_violation
""")
def geography_dimension(t: Tables) -> DataFrame:
    return D.dim_geography(SV.silver_geography(*county_sources(t)).filter(~c("_has_violation")))


def _resources(t: Tables) -> DataFrame:
    """Workforce rows per nation and year in two code layouts, from order priorities."""
    pieces = t.customer.select("c_custkey", "c_nationkey").join(
        t.orders.groupBy("o_custkey", F.year("o_orderdate").alias("data_year"))
        .agg(F.count_if(c("o_orderpriority") == "3-MEDIUM").alias("n_medium"), F.count(F.lit(1)).alias("n")),
        c("c_custkey") == c("o_custkey"),
    ).groupBy("c_nationkey", "data_year").agg(F.sum("n_medium").alias("n_medium"), F.sum("n").alias("n"))
    code = F.lpad(c("c_nationkey").cast("string"), 5, "0")
    old = c("data_year") < 1998
    number = F.format_string("%d,%03d", F.floor(c("n") / 1000).cast("int"), (c("n") % 1000).cast("int"))
    return pieces.select(
        F.when(old, F.substring(code, 1, 2)).alias("f00011"),
        F.when(old, F.substring(code, 3, 3)).alias("f00012"),
        F.substring(code, 1, 2).alias("fips_st"),
        F.substring(code, 3, 3).alias("fips_cnty"),
        "data_year",
        F.when(c("n_medium") > 0, number).otherwise("").alias("f1130820"),
        c("n").cast("string").alias("f1130819"),
        c("n_medium").cast("string").alias("stgh_rn_ft_incl_nh_21"),
        F.when(~old, "7").alias("aprn_npi_22"),
        c("n").cast("string").alias("f1464619"),
    )


@check("B04 D07 Q05", f"""
SELECT g.county_fips, g.census_year, people AS total_population,
  round(CAST(band_a + band_b AS DOUBLE) / people * 100, 4) AS pop_65_plus_pct,
  round(CAST(people AS DOUBLE) / area_km2, 4) AS population_density,
  CAST(people * 100 AS DOUBLE) AS median_household_income,
  CASE WHEN universe > 0 THEN round(CAST(poor AS DOUBLE) / universe * 100, 4) END AS poverty_rate_pct,
  CASE WHEN universe > 0 THEN round(CAST(band_a + band_b AS DOUBLE) / universe * 100, 4) END AS uninsured_rate_pct,
  round(CAST(people AS DOUBLE) / people * 100000, 4) AS physicians_per_100k,
  round(CAST(CASE WHEN g.census_year >= 1998 THEN medium + 7 ELSE people END AS DOUBLE) / people * 100000, 4)
    AS nurses_per_100k,
  rucc_code, rucc_description, FALSE AS _has_violation, CAST(NULL AS VARCHAR) AS error_reason
FROM ({CENSUS_SQL}) g
JOIN (SELECT lpad(CAST(c_nationkey AS VARCHAR), 5, '0') AS county_fips, CAST(year(o_orderdate) AS INTEGER) AS census_year,
    COUNT(*) FILTER (o_orderpriority = '3-MEDIUM') AS medium
  FROM customer JOIN orders ON o_custkey = c_custkey GROUP BY 1, 2) m
  ON g.county_fips = m.county_fips AND g.census_year = m.census_year
LEFT JOIN (SELECT lpad(CAST(n_nationkey AS VARCHAR), 5, '0') AS county_fips, CAST(n_nationkey % 9 + 1 AS INTEGER) AS rucc_code,
    n_name AS rucc_description, CAST((n_nationkey + 1) * 100 AS DOUBLE) AS area_km2 FROM nation) n
  ON g.county_fips = n.county_fips
""")
def population_silver(t: Tables) -> DataFrame:
    rural = t.nation.select(
        F.lpad(c("n_nationkey").cast("string"), 5, "0").alias("county_fips"),
        (c("n_nationkey") % 9 + 1).alias("rucc_code_raw"),
        c("n_name").alias("rucc_description"),
    )
    return SV.silver_population(census_counts(t), _resources(t), rural, V.geography(t))


@check("B04 W02 P23 D17", oracle("""
SELECT CAST('0x' || substr(md5(county_fips || '_' || CAST(census_year AS VARCHAR)), 1, 15) AS BIGINT) AS population_sk,
  county_fips, census_year, total_population, pop_65_plus_pct, population_density, median_household_income,
  poverty_rate_pct, uninsured_rate_pct, physicians_per_100k, nurses_per_100k, rucc_code, 'new' AS rucc_description,
  metro_nonmetro_flag
FROM v_population
""", "v_population"))
def population_dimension(t: Tables) -> DataFrame:
    p = V.population(t)
    files = [
        p.withColumns({"rucc_description": F.lit(text), "source_file_path": F.lit(path)})
        for text, path in (("old", "a/1.parquet"), ("new", "a/2.parquet"))
    ]
    return D.dim_population(stack(files))


@check("B05 W01", oracle("""
SELECT CAST('0x' || substr(md5(hospital_id), 1, 15) AS BIGINT) AS hospital_sk, hospital_id, hospital_name,
  CASE WHEN hospital_type = 'Psychiatric' THEN 'Unknown' ELSE hospital_type END AS hospital_type, county_fips, zip_code,
  state, certified_bed_count, latitude, longitude
FROM v_hospitals
""", "v_hospitals"))
def hospital_dimension(t: Tables) -> DataFrame:
    h = V.hospitals(t).withColumn("hospital_type", F.nullif("hospital_type", F.lit("Psychiatric")))
    older = h.withColumns({"hospital_name": F.lit("old name"), "source_file_path": F.lit("f/2020.parquet")})
    newer = h.withColumns({
        "hospital_name": F.concat(F.lit(" "), c("hospital_name"), F.lit(" ")),
        "source_file_path": F.lit("f/2021.parquet"),
    })
    return D.dim_hospital(stack([older, newer]))


@check("B06 X13", oracle("SELECT * FROM v_calendar", "v_calendar"))
def date_dimension(t: Tables) -> DataFrame:
    return D.dim_date_of(t.lineitem, "l_shipdate")


@check("B07 F05 X21", oracle("""
SELECT CAST('0x' || substr(md5(hospital_id || '_' || CAST(collection_week AS VARCHAR)), 1, 15) AS BIGINT) AS fact_id,
  hospital_id, collection_week, state, CAST(round(inpatient_beds_capacity) AS BIGINT) AS inpatient_beds_capacity,
  CAST(round(inpatient_beds_used) AS BIGINT) AS inpatient_beds_used,
  CAST(round(icu_beds_capacity) AS BIGINT) AS icu_beds_capacity, CAST(round(icu_beds_used) AS BIGINT) AS icu_beds_used,
  CAST(round(covid_hospitalized_patients) AS BIGINT) AS covid_hospitalized_patients,
  CAST(round(covid_icu_patients) AS BIGINT) AS covid_icu_patients,
  CAST(round(influenza_hospitalized_patients) AS BIGINT) AS influenza_hospitalized_patients,
  CAST(round(influenza_icu_patients) AS BIGINT) AS influenza_icu_patients,
  CAST(round(ed_visits_total) AS BIGINT) AS ed_visits_total,
  CAST(round(covid_admissions_adult) AS BIGINT) AS covid_admissions_adult,
  CAST(round(covid_admissions_pediatric) AS BIGINT) AS covid_admissions_pediatric,
  CAST(round(pediatric_beds_capacity) AS BIGINT) AS pediatric_beds_capacity,
  CAST(round(pediatric_beds_used) AS BIGINT) AS pediatric_beds_used, is_corrected,
  round(inpatient_occupancy_rate, 6) AS inpatient_occupancy_rate, round(icu_occupancy_rate, 6) AS icu_occupancy_rate,
  overload_flag
FROM v_fact WHERE collection_week BETWEEN DATE '2001-06-30' - 7 AND DATE '2001-06-30'
""", "v_fact"))
def staged_fact(t: Tables) -> DataFrame:
    return _rounded(stage_fact(V.weekly(t), V.AS_OF, audit=False))


@check("B08 J09 SC08 SC09", """
SELECT county_fips, hrr_region, hrrnum, 'v1' AS hrr_vintage FROM (
  SELECT lpad(CAST(l_suppkey AS VARCHAR), 10, '0') AS county_fips, p_brand || '-' || p_type AS hrr_region,
    CAST(p_size AS VARCHAR) AS hrrnum,
    ROW_NUMBER() OVER (PARTITION BY l_suppkey
      ORDER BY SUM(l_quantity) DESC, p_brand || '-' || p_type, CAST(p_size AS VARCHAR)) AS rn
  FROM (SELECT l_suppkey, l_quantity, lpad(CAST(l_partkey % 90000 AS VARCHAR), 5, '0') AS zip5 FROM lineitem) l
  JOIN (SELECT * FROM (SELECT *, lpad(CAST(p_partkey % 90000 AS VARCHAR), 5, '0') AS zip5,
      ROW_NUMBER() OVER (PARTITION BY lpad(CAST(p_partkey % 90000 AS VARCHAR), 5, '0')
        ORDER BY p_brand || '-' || p_type, CAST(p_size AS VARCHAR) DESC) AS k FROM part) x WHERE k = 1) p
  ON l.zip5 = p.zip5 GROUP BY l_suppkey, p_brand, p_type, p_size) g WHERE rn = 1
""")
def county_regions(t: Tables) -> DataFrame:
    regions = t.part.select(
        (c("p_partkey") % 90000).cast("string").alias(" ZIPCODE19"), c("p_size").cast("string").alias("HRRNUM"),
        F.concat(F.lit(" "), c("p_brand")).alias("HrrState"), F.concat("p_type", F.lit(" ")).alias("hrrcity "),
    )
    pieces = t.lineitem.select(
        pad_code(c("l_partkey") % 90000, 5).alias("GEOID_ZCTA5_20"),
        V.key10(c("l_suppkey")).alias("GEOID_COUNTY_20"),
        c("l_quantity").cast("string").alias("AREALAND_PART"),
    )
    return B.county_region(B.area_pieces(pieces), B.zip_regions(regions, "v1"))


@check("B09 A03 A04 P12 F03", """
SELECT lpad(CAST(c_custkey % 90000 AS VARCHAR), 5, '0') AS county_fips, 'S' || CAST(c_custkey // 90000 AS VARCHAR) AS state_abbr,
  c_name AS county_name_usda, CAST(c_nationkey % 9 + 1 AS BIGINT) AS rucc_code_raw, '2023' AS rucc_vintage,
  'text of ' || c_name AS rucc_description, CAST(floor(abs(c_acctbal)) AS BIGINT) AS reference_population
FROM customer WHERE c_acctbal >= 0
""")
def rural_code_table(t: Tables) -> DataFrame:
    people = F.floor(F.abs("c_acctbal")).cast("string")
    code = F.when(c("c_acctbal") >= 0, (c("c_nationkey") % 9 + 1).cast("string"))
    wide = t.customer.select(
        (c("c_custkey") % 90000).cast("string").alias(" FIPS"),
        F.concat(F.lit("S"), F.expr("c_custkey div 90000").cast("string")).alias("State"), c("c_name").alias("County_Name"),
        code.alias("RUCC_2023"), people.alias("Population_2020"),
        F.concat(F.lit("text of "), c("c_name")).alias("Description"),
    )
    names = ["RUCC_2023", "Population_2020", "Description"]
    long = wide.unpivot([" FIPS", "State", "County_Name"], names, "Attribute", "Value")
    return B.rural_codes(long)


@check("B10 P15 P16 P17 P07", """
SELECT array_to_string(list_transform(string_split(lower(o_orderpriority), ' '),
    lambda w: upper(substr(w, 1, 1)) || substr(w, 2)), ' ') AS state_name,
  CAST(year(o_orderdate) AS BIGINT) AS season_start_year, CAST(year(o_orderdate) AS VARCHAR) || '-next' AS "SEASON",
  CAST(week(o_orderdate) AS BIGINT) AS week,
  CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(o_orderdate AS DATE) END AS weekend_date,
  CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS activity_level_raw, o_orderstatus AS "ACTIVITY_LEVEL_LABEL",
  'orders' AS source
FROM orders
""")
def flu_weeks(t: Tables) -> DataFrame:
    d = c("o_orderdate").cast("date")
    raw = t.orders.select(
        F.concat(F.lit(" "), F.lower("o_orderpriority")).alias("statename"),
        F.substring("o_orderpriority", 1, 1).alias("Activity Level"),
        c("o_orderstatus").alias("ACTIVITY LEVEL LABEL"),
        F.when(c("o_orderstatus") == "P", "n/a").otherwise(F.date_format(d, "MMM-dd-yyyy")).alias("WEEKEND"),
        F.weekofyear(d).cast("string").alias("week "),
        F.concat(F.year(d).cast("string"), F.lit("-next")).alias("SEASON"),
    )
    return B.flu_state_week(raw, "orders")


# --- payload tables ---------------------------------------------------------------------------


@check("SC14 X22 B12 P11", """
SELECT lpad(CAST(c_nationkey AS VARCHAR), 2, '0') || lpad(CAST(c_custkey AS VARCHAR), 3, '0') AS county_fips,
  2021 AS census_year, lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS state, lpad(CAST(c_custkey AS VARCHAR), 3, '0') AS county,
  c_acctbal AS total_population_raw, CAST(NULL AS DOUBLE) AS median_household_income_raw,
  CAST(c_custkey AS DOUBLE) AS "age_raw_B01001_020E"
FROM customer
""")
def census_payloads(t: Tables) -> DataFrame:
    """One JSON matrix per customer, parsed back to typed census rows."""
    names = ["B01001_001E", "B19013_001E", "B01001_020E", "state", "county"]
    values = [c("c_acctbal").cast("string"), F.nullif("c_mktsegment", F.lit("MACHINERY")), c("c_custkey").cast("string"),
              F.lpad(c("c_nationkey").cast("string"), 2, "0"), F.lpad(c("c_custkey").cast("string"), 3, "0")]
    matrix = F.array(F.array(*[F.lit(n) for n in names]), F.array(*values))
    return B.census_year(rows_from_json_matrix(t.customer.select(F.to_json(matrix).alias("body")), "body", names), 2021)


@check("B11 F01 F02 P07", """
SELECT CASE WHEN catchment = 'Entire Network' THEN 'national' ELSE 'state' END AS level, COUNT(*) AS n,
  round(SUM(rate), 2) AS total_rate
FROM (SELECT CASE WHEN o_orderstatus = 'F' THEN 'Entire Network' ELSE o_orderstatus END AS catchment,
    CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_totalprice END AS rate
  FROM orders WHERE o_orderpriority = '1-URGENT') g GROUP BY 1
""")
def flu_surveillance_rates(t: Tables) -> DataFrame:
    rows = t.orders.select(
        F.when(c("o_orderstatus") == "F", " Entire Network").otherwise(c("o_orderstatus")).alias("CATCHMENT"),
        F.when(c("o_orderpriority") == "1-URGENT", " OVERALL").otherwise("0-4 yr").alias("AGE_CATEGORY"),
        F.lit("Overall").alias("SEX_CATEGORY"),
        F.when(c("o_orderstatus") == "P", "null").otherwise(c("o_totalprice").cast("string")).alias("WEEKLY_RATE"),
    )
    national, states = B.by_catchment(B.flu_surveillance(rows, "orders"))
    return stack([
        df.agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("WEEKLY_RATE"), 2).alias("total_rate"))
        .select(F.lit(level).alias("level"), "n", "total_rate")
        for level, df in (("national", national), ("state", states))
    ])
