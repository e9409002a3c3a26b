from __future__ import annotations

import pytest
from conftest import rows
from pyspark.sql import functions as F

from wardmill import schemas
from wardmill.constants import AGE_65_PLUS
from wardmill.operators import quality as Q
from wardmill.plans import silver as S

AS_OF = "2021-06-01"
UTIL = [f.split()[0] for f in schemas.BRONZE_UTILIZATION.split(", ")]


def usage(spark, *cases):
    """(key, total, used, icu staffed, icu used, covid, week)"""
    data = [(k, " mercy ", "al", "069", w, t, u, s, i, v) for k, t, u, s, i, v, w in cases]
    return spark.createDataFrame(data, schemas.BRONZE_UTILIZATION)


@pytest.mark.parametrize("case, codes", [
    (("100", "80", "10", "5", "8", "2021-01-01"), []),
    (("100", "130", "10", "5", "8", "2021-01-01"), ["R1_occupancy_over_120"]),
    (("100", "80", "10", "12", "8", "2021-01-01"), ["R2_icu_used_gt_staffed"]),
    (("8", "6", "10", "5", "4", "2021-01-01"), ["R3_icu_gt_total_beds"]),
    (("0", "5", "0", "0", "1", "2021-01-01"), ["R4_zero_beds_but_patients"]),
    (("100", "80", "10", "5", "90", "2021-01-01"), ["R5_covid_gt_total"]),
    (("100", "80", "10", "5", "8", "2021-06-02"), ["R6_future_report_date"]),
    (("100", "80", "10", "5", "8", AS_OF), []),
    (("100", "130", "10", "12", "8", "2021-01-01"), ["R1_occupancy_over_120", "R2_icu_used_gt_staffed"]),
    (("nan", "None", "nan", "nan", "nan", "2021-01-01"), []),
    (("x", "", None, "nan", "nan", "not a date"), ["R7_missing_key"]),
])
def test_each_rule(spark, case, codes):
    df = Q.apply_rules(S.silver_utilization(usage(spark, ("1", *case))), Q.utilization_rules(AS_OF))
    row = df.first()
    assert row["_violations"] == codes
    assert row["_has_violation"] == bool(codes)
    assert df.select(Q.first_violation(F.col("_violations"))).first()[0] == (codes[0] if codes else None)


def test_rules_skip_absent_columns(spark):
    df = spark.createDataFrame([("1", 130.0)], "provider_id string, occupancy_rate double")
    assert Q.apply_rules(df, Q.facility_rules(AS_OF)).first()["_violations"] == []
    assert Q.apply_rules(df, Q.utilization_rules(AS_OF)).first()["_violations"] == ["R1_occupancy_over_120"]


def test_utilization_types_text_and_key(spark):
    df = S.silver_utilization(usage(
        spark, ("1", "100", "80", "10", "5", "8", "2021-01-01"), ("1", "100", "90", "10", "5", "8", "2021-01-01")
    ), AS_OF)
    row = df.collect()
    assert len(row) == 1
    assert (row[0]["facility_name"], row[0]["state"], row[0]["occupancy_rate"]) == ("MERCY", "AL", 90.0)
    assert row[0]["total_patients"] == row[0]["inpatient_beds_used"] == 90.0


def test_facility_keeps_the_newest_row(spark):
    data = [
        ("010001", " Mercy Hospital ", " dothan", "al", "36301", "069", "420", "01", "20200101"),
        ("010001", "MERCY HOSPITAL", "dothan", "al", "36301", "069", "None", "01", "20210315"),
        ("010005", "nan", None, "al", "01234", "001", "", "01", "bad"),
    ]
    df = S.silver_facility(
        spark.createDataFrame(data, schemas.BRONZE_FACILITY), order=[F.col("CRTFCTN_DT").desc_nulls_last()]
    )
    assert rows(df, "provider_id") == [
        ("010001", "MERCY HOSPITAL", "DOTHAN", "AL", "36301", "069", None, "01"),
        ("010005", None, None, "AL", "01234", "001", None, "01"),
    ]


def test_geography_gate_and_complement(spark):
    names = spark.createDataFrame([
        ("06037", "Los Angeles County", "California", "CA"), ("1234", "X County", "S", "S"),
        (None, "Y", "S", "S"), ("06038", "Z", "S", None),
    ], "county_fips string, county_name string, state_name string, state_code string")
    area = spark.createDataFrame([("06037", 10.0)], "county_fips string, area_km2 double")
    region = spark.createDataFrame([("06037", "CA-LA")], "county_fips string, hrr_region string")
    df = S.silver_geography(names, area, region)
    assert [r["county_fips"] for r in df.filter("NOT _has_violation").collect()] == ["06037"]
    assert df.filter("_has_violation AND error_reason IS NOT NULL").count() == 3
    assert df.filter("county_fips = '06037'").first()["county_name"] == "Los Angeles"


def census(spark, *people):
    bands = ", ".join(f"age_raw_{v} double" for v in AGE_65_PLUS)
    ddl = (
        "county_fips string, census_year int, total_population_raw double, median_household_income_raw double, "
        "pop_below_poverty_raw double, poverty_universe_raw double, uninsured_19_64_raw double, "
        f"uninsured_65_plus_raw double, insurance_universe_raw double, {bands}"
    )
    return spark.createDataFrame([(*p, *([1.0] * 12)) for p in people], ddl)


def test_population_rates_workforce_and_gate(spark):
    c = census(
        spark,
        ("01001", 2022, 1000.0, 5.0, 10.0, 0.0, 1.0, 2.0, 300.0),
        ("01001", 2023, -1.0, 5.0, 10.0, 100.0, 1.0, None, 300.0),
        ("01003", None, 10.0, 5.0, 10.0, 100.0, 1.0, 2.0, 300.0),
    )
    resources = spark.createDataFrame(
        [("01", "001", None, None, 2022, "1,234", "", "50", "7"), (None, None, "01", "001", 2023, None, "9", None, None)],
        "f00011 string, f00012 string, fips_st string, fips_cnty string, data_year int, f1130820 string, "
        "f1130819 string, stgh_rn_ft_incl_nh_21 string, aprn_npi_22 string",
    )
    rural = spark.createDataFrame([("01001", 2, "Metro area")], "county_fips string, rucc_code_raw int, rucc_description string")
    geo = spark.createDataFrame([("01001", 4.0)], "county_fips string, area_km2 double")
    got = {(r["county_fips"], r["census_year"]): r for r in S.silver_population(c, resources, rural, geo).collect()}
    ok = got["01001", 2022]
    assert (ok["pop_65_plus_pct"], ok["poverty_rate_pct"], ok["uninsured_rate_pct"]) == (1.2, None, 1.0)
    assert (ok["population_density"], ok["physicians_per_100k"], ok["nurses_per_100k"]) == (250.0, 123400.0, 5700.0)
    assert ok["rucc_code"] == 2 and not ok["_has_violation"]
    assert got["01001", 2023]["_has_violation"] and got["01001", 2023]["uninsured_rate_pct"] is None
    assert got["01003", None]["_has_violation"]


def test_stop_on_too_many_bad_rows():
    Q.enforce_max_bad_rate({"total_rows": 10, "quarantine_rows": 2})
    Q.enforce_max_bad_rate({"total_rows": 0, "quarantine_rows": 0})
    with pytest.raises(RuntimeError):
        Q.enforce_max_bad_rate({"total_rows": 10, "quarantine_rows": 3})


def test_rows_without_a_readable_date_all_reach_quarantine(spark):
    bad = [("1", "100", str(50 + i), "10", "5", "8", "someday") for i in range(3)]
    df = Q.apply_rules(S.silver_utilization(usage(spark, *bad, ("1", "100", "80", "10", "5", "8", "2021-01-01"))), Q.utilization_rules(AS_OF))
    assert sorted(r["_has_violation"] for r in df.collect()) == [False, True, True, True]
