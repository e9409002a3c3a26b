from __future__ import annotations

import datetime
import os

import pytest
from conftest import rows

from wardmill.constants import AGE_65_PLUS
from wardmill.operators.aggregates import coverage, snapshot_quarter
from wardmill.plans import bronze as B
from wardmill.sources.text_formats import rows_from_json_matrix


def test_county_names(spark):
    df = spark.createDataFrame([("Los Angeles County, California", "06", "037"), ("Nowhere", "99", "001")],
                               "NAME string, state string, county string")
    got = rows(B.county_names(df, 2023).select("county_fips", "county_name", "state_name", "state_code"))
    assert got == [("06037", "Los Angeles County", "California", "CA"), ("99001", "Nowhere", None, None)]


def test_county_area(spark):
    df = spark.createDataFrame([("1001", "10"), ("01003", "x")], "GEOID string, ALAND_SQMI string")
    assert rows(B.county_area(df, 2024)) == [("01001", 10.0, 25.8999, 2024), ("01003", None, None, 2024)]


def test_region_by_plurality(spark):
    regions = B.zip_regions(spark.createDataFrame(
        [("1001", "7", " MA", "Boston "), ("01001", "7", "MA", "Boston"), ("2002", "8", "CT", "Hartford")],
        ["zipcode19", "HRRNUM", " HrrState", "hrrcity "]), "2019")
    assert regions.count() == 2
    pieces = B.area_pieces(spark.createDataFrame([
        ("01001", "25001", "60"), ("02002", "25001", "40"),       # clear majority
        ("01001", "25002", "50"), ("02002", "25002", "50"),       # tie: smallest region name
        ("09999", "25003", "10"),                                 # zip without region
        ("01001", None, "10"),                                    # no county
    ], "GEOID_ZCTA5_20 string, GEOID_COUNTY_20 string, AREALAND_PART string"))
    got = B.county_region(pieces, regions)
    assert rows(got.select("county_fips", "hrr_region")) == [("25001", "MA-Boston"), ("25002", "CT-Hartford")]
    cover = coverage(pieces, got, "county_fips").first()
    assert (cover["total_keys"], cover["mapped_keys"], cover["coverage_ok"]) == (3, 2, False)


def test_region_contract(spark):
    with pytest.raises(ValueError, match="hrrcity"):
        B.zip_regions(spark.createDataFrame([("1", "2")], ["zipcode", "hrrnum"]), "2019")


def test_rural_codes_by_role(spark):
    df = spark.createDataFrame([
        ("1001", "AL", "Autauga", "RUCC_2023", "2"), ("1001", "AL", "Autauga", "Population_2020", "58805"),
        ("1001", "AL", "Autauga", "Description", "Metro"), (None, "AL", "x", "RUCC_2023", "3"),
        ("100100", "AL", "long", "RUCC_2023", "4"), ("1003", "AL", "bad", "RUCC_2023", "n/a"),
    ], ["FIPS ", "State", "County_Name", "Attribute", "Value"])
    expected = [("01001", "AL", "Autauga", 2, "2023", "Metro", 58805)]
    assert rows(B.rural_codes(df)) == expected
    assert rows(B.rural_codes(df, {"code": "RUCC_2023"})) == [("01001", "AL", "Autauga", 2, "2023")]
    assert B.rural_codes(df.filter("Attribute = 'Description'")).isEmpty()
    for roles in ({"population": "Population_2020"}, {"code": "RUCC_2023", "description": "RUCC_2023"}, {"code": "x", "name": "y"}):
        with pytest.raises(ValueError):
            B.rural_codes(df, roles)


def test_flu_state_week(spark):
    df = spark.createDataFrame(
        [("new york", "3", "High", "Mar-05-2022", "9", "2021-22"), ("guam", "x", "Low", "bad", "", None)],
        ["STATENAME", "ACTIVITY LEVEL", "ACTIVITY LEVEL LABEL", "WEEKEND", "WEEK", "SEASON"])
    got = rows(B.flu_state_week(df, "s"), "state_name")
    assert got == [
        ("Guam", None, None, None, None, None, "Low", "s"),
        ("New York", 2021, "2021-22", 9, datetime.date(2022, 3, 5), 3, "High", "s"),
    ]
    with pytest.raises(ValueError, match="SEASON"):
        B.flu_state_week(df.drop("SEASON"))


def test_census_year_from_payload(spark):
    names = ["B01001_001E", "B17001_001E", *AGE_65_PLUS, "state", "county"]
    payload = [names, ["58805", "x", *["1"] * 12, "01", "001"]]
    import json

    df = spark.createDataFrame([(json.dumps(payload),)], "body string")
    row = B.census_year(rows_from_json_matrix(df, "body"), 2021).first()
    assert (row["county_fips"], row["census_year"], row["total_population_raw"]) == ("01001", 2021, 58805.0)
    assert row["poverty_universe_raw"] is None and row["age_raw_B01001_049E"] == 1.0


def test_snapshot_quarter(spark):
    df = spark.createDataFrame([("20210315",), ("bad",), (None,), ("20210701 00:00",)], "d string")
    assert snapshot_quarter(df, "d").first()["quarter"] == "q1_2021"
    assert snapshot_quarter(df.filter("d = 'bad'"), "d").first()["quarter"] is None


def test_vintages_are_the_folders_that_exist(spark, folder):
    from wardmill.jobs.bronze import vintages

    for name in ("names_2019", "names_2034", "names_old", "old_names_2040", "area_2036"):
        os.makedirs(f"{folder}/{name}")
    assert vintages(spark, folder, "names") == [2034, 2019] and vintages(spark, folder, "area") == [2036]
    with pytest.raises(FileNotFoundError):
        vintages(spark, folder, "region")
