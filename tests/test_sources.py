from __future__ import annotations

import json
import os

import pytest
from conftest import plan_of, rows
from pyspark.sql import functions as F

from wardmill.operators.shape import apply_layout_names, normalise_headers, require_columns, unique_names
from wardmill.plans.bronze import by_catchment, flu_surveillance
from wardmill.sources import readers as R
from wardmill.sources import text_formats as X


def write(folder, name, text, encoding="utf-8"):
    path = os.path.join(folder, name)
    with open(path, "w", encoding=encoding) as f:
        f.write(text)
    return path


def test_parquet_scans(spark, folder):
    df = spark.createDataFrame([("a", 1, "x")], "k string, v int, unused string")
    df.write.parquet(f"{folder}/src/2024-01-01/data.parquet")
    df.write.parquet(f"{folder}/many/part_a.parquet")
    assert rows(R.read_dated(spark, folder, "src", "2024-01-01", "k string, v int")) == [("a", 1)]
    got = R.with_lineage(R.read_glob(spark, f"{folder}/src/2024-01-01/data.parquet", "*.parquet", "k string"), "s", "2024-01-02")
    assert got.columns == ["k", "_source_file", "_ingested_at"] and got.first()["_source_file"] == "s"
    assert "part_a.parquet" in R.with_source_path(spark.read.parquet(f"{folder}/many/part_a.parquet")).first()["source_file_path"]


def test_external_table_keeps_partition_text_and_prunes(spark, folder):
    df = spark.createDataFrame([("a", 1, "01"), ("b", 2, "02")], "k string, v int, exec_date string")
    folder = f"{folder}/t"
    df.write.partitionBy("exec_date").parquet(folder)
    whole = R.read_external(spark, folder, "k string, v int")
    assert rows(whole) == [("a", 1, "01"), ("b", 2, "02")]
    one = R.read_partition(spark, folder, "k string, v int", "02")
    assert rows(one) == [("b", 2, "02")]
    assert "PartitionFilters: [isnotnull(exec_date" in plan_of(one)


def test_delimited_text(spark, folder):
    path = write(folder, "a.txt", "GEOID| NAME \n01001|Á\n", "utf-8-sig")
    got = X.read_delimited(spark, path, "|", columns=["GEOID", "NAME"])
    assert got.dtypes == [("GEOID", "string"), ("NAME", "string")] and rows(got) == [("01001", "Á")]
    latin = write(folder, "b.csv", "a,b\n1,é\n", "latin-1")
    assert rows(X.read_delimited(spark, latin, encoding="ISO-8859-1")) == [("1", "é")]


HEADER = "CATCHMENT,NETWORK,YEAR,YEAR,WEEK,AGE CATEGORY,SEX CATEGORY,RACE CATEGORY,VIRUS TYPE CATEGORY,WEEKLY RATE"


def test_csv_with_preamble(spark, folder):
    body = ("A disclaimer about surveillance\nmore text, with a comma\n" + HEADER + "\n"
            "Entire Network,F,2009-10,2009,35,Overall,OVERALL, Overall,Overall,0.5\n"
            "Iowa,F,2009-10,2009,35,Overall,Overall,Overall,Overall,null\n"
            "Iowa,F,2009-10,2009,35,0-4 yr,Overall,Overall,Overall,1.5\n\n")
    path = write(folder, "flu.csv", body, "utf-8-sig")
    df = X.read_csv_with_preamble(
        spark, path, ["CATCHMENT", "SURVEILLANCE", "YEAR"], {"YEAR": ["SEASON_YEAR", "MMWR_YEAR"]}
    )
    assert df.columns[:4] == ["CATCHMENT", "NETWORK", "SEASON_YEAR", "MMWR_YEAR"] and df.count() == 3
    got = flu_surveillance(df, "f")
    assert got.count() == 2
    national, states = by_catchment(got)
    assert national.first()["WEEKLY_RATE"] == 0.5 and national.first()["MMWR_YEAR"] == 2009.0
    assert states.first()["WEEKLY_RATE"] is None
    with pytest.raises(ValueError):
        X.read_csv_with_preamble(spark, write(folder, "no.csv", "a,b\n1,2\n"), ["CATCHMENT"])


def test_preamble_of_a_split_file(spark, folder):
    lines = [f"Iowa,F,{i},{i},1,Overall,Overall,Overall,Overall,{i}" for i in range(5000)]
    path = write(folder, "big.csv", "one\ntwo\n" + HEADER + "\n" + "\n".join(lines) + "\n")
    small = "20000"
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", small)
    try:
        df = X.read_csv_with_preamble(spark, path, ["CATCHMENT"], {"YEAR": ["SEASON_YEAR", "MMWR_YEAR"]})
        assert df.agg(F.count("*"), F.sum(F.col("WEEKLY_RATE").cast("long"))).first()[:] == (5000, sum(range(5000)))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_one_year_column_is_the_week_year():
    assert X.header_names("CATCHMENT,YEAR,AGE CATEGORY", {"YEAR": ["SEASON_YEAR", "MMWR_YEAR"]}) == [
        "CATCHMENT", "MMWR_YEAR", "AGE_CATEGORY"
    ]


LAYOUT = """proc import;
@00001 f00001 $ 5. /*County FIPS*/
@00006 f00002   3. /* Total  beds (%) */
@00009 f00003 $ 2. /*County FIPS*/
"""


def test_fixed_width(spark, folder):
    layout = X.read_layout(spark, write(folder, "l.sas", LAYOUT, "latin-1"))
    assert [(f.start, f.width, f.name) for f in layout] == [
        (1, 5, "County_FIPS"), (6, 3, "Total_beds_"), (9, 2, "County_FIPS_1")
    ]
    data = write(folder, "d.asc", "01001 12AL\n01003   é \n", "latin-1")
    assert rows(X.read_fixed_width(spark, data, layout)) == [("01001", "12", "AL"), ("01003", None, "é")]


def test_layout_names(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["a", "b", "c"])
    assert apply_layout_names(df, ["x", "x"]).columns == ["x", "x_1", "c"]
    assert unique_names(["a", "b", "a", "a"]) == ["a", "b", "a_1", "a_2"]


def test_vintages(spark, folder):
    spark.createDataFrame([("a",)], "k string").write.parquet(f"{folder}/g_2022")
    read = lambda p: spark.read.parquet(p)
    got = R.read_latest_vintage(spark, f"{folder}/g_{{}}", [2024, 2022, 2020], read, "gaz_vintage")
    assert rows(got) == [("a", 2022)]
    with pytest.raises(FileNotFoundError):
        R.read_latest_vintage(spark, f"{folder}/h_{{}}", [1], read)
    one, two = spark.createDataFrame([("a", 1)], "k string, x int"), spark.createDataFrame([("b", 2)], "k string, y int")
    assert rows(R.read_vintages([(2020, one), (2021, two)]).select("k", "x", "y", "data_year")) == [
        ("a", 1, None, 2020), ("b", None, 2, 2021)
    ]


def test_json_payloads(spark, folder):
    df = spark.createDataFrame([('[["v","state"],["1","01"],[null,"02"]]',), ("broken",)], "body string")
    assert rows(X.rows_from_json_matrix(df.limit(1), "body")) == [("1", "01"), (None, "02")]
    path = write(folder, "r.json", json.dumps([{"a": 1, "b": None}, {"a": "x", "c": 2.5}]))
    got = X.read_json_records(spark, path)
    assert set(got.dtypes) == {("a", "string"), ("b", "string"), ("c", "string")} and got.count() == 2
    assert rows(X.read_json_records(spark, path, "a string")) == [("1",), ("x",)]


def test_headers_and_contract(spark):
    df = spark.createDataFrame([(1, 2)], ["﻿State Name ", "zipcode18"])
    assert normalise_headers(df, "lower", {"zipcode18": "zipcode"}).columns == ["state_name", "zipcode"]
    with pytest.raises(ValueError, match="missing columns: \\['hrr'\\]"):
        require_columns(df, ["hrr", "zipcode18"])


def test_preamble_headers_of_any_width(spark, folder):
    wide, narrow = write(folder, "w1.csv", "note\nCATCHMENT,A,B,C\nx,1,2,3\n"), write(folder, "w2.csv", "note, with, many, commas\nB,CATCHMENT\n9,y\n")
    got = X.read_csv_with_preamble(spark, [wide, narrow], ["CATCHMENT"])
    assert rows(got.select("CATCHMENT", "A", "B", "C")) == [("x", "1", "2", "3"), ("y", None, "9", None)]
    with pytest.raises(ValueError, match="w3"):
        X.read_csv_with_preamble(spark, [wide, write(folder, "w3.csv", "a,b\n1,2\n")], ["CATCHMENT"])


def test_layout_lines():
    assert X.layout_field("@1 a 5. /*x*/") == X.FixedField(1, 5, "x")
    assert X.layout_field("  @00012   f3   $12.   /* Beds, total */ ;") == X.FixedField(12, 12, "Beds_total")
    for line in ("input", "@1 a /*x*/", "@1 a 5 /*x*/", "@x a 5. /*x*/", "@1 a 5. no label", "/*x*/ @1 a 5."):
        assert X.layout_field(line) is None


def test_each_payload_by_its_own_header(spark):
    df = spark.createDataFrame([('[["a","b"],["1","2"]]',), ('[["b","a","c"],["20","10","30"]]',)], "body string")
    assert rows(X.rows_from_json_matrix(df, "body").select("a", "b", "c")) == [("1", "2", None), ("10", "20", "30")]
    twice = spark.createDataFrame([('[["a","a"],["1","2"]]',)], "body string")
    assert rows(X.rows_from_json_matrix(twice, "body", ["a", "a"])) == [("1", "2")]
