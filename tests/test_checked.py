from __future__ import annotations

import json
import os

import pytest
from conftest import plan_of, rows

from wardmill import schemas
from wardmill.constants import AGE_65_PLUS
from wardmill.jobs import bronze, gold, silver
from wardmill.operators.quality import TooManyBadRows
from wardmill.plans.bronze import CENSUS_COLUMNS
from wardmill.plans.params import RunParams
from wardmill.sources import checked as K
from wardmill.sources import writers as W
from wardmill.sources.text_formats import FixedField


def put(path, text, encoding="utf-8"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(text.encode(encoding))


def bad(df, spark, path):
    return [(os.path.basename(r["file"]), r["line"], r["reason"], r["record"]) for r in K.bad_lines(df, spark, path).orderBy("file", "line").collect()]


def test_delimited(spark, folder):
    """Byte-order mark, carriage returns, quotes, blank lines, repeated headers, several files that are split."""
    put(f"{folder}/in/a.csv", '﻿k, v\r\n1,x\r\n2\r\n"3","a,b"\r\n\r\n4,"he said ""no"""\r\n5,"open\r\n6,x,y\r\n')
    put(f"{folder}/in/b.csv", "k,v\n7,\n")
    got = K.checked_delimited(spark, f"{folder}/in", ["k", "v"])
    assert rows(got.filter("NOT _has_violation").select("k", "v")) == [("1", "x"), ("3", "a,b"), ("4", 'he said "no"'), ("7", None)]
    assert [x[:3] for x in bad(got, spark, f"{folder}/in")] == [("a.csv", 3, "short"), ("a.csv", 7, "quote"), ("a.csv", 8, "long")]
    assert rows(got.filter("_has_violation").select("k", "v").distinct()) == [(None, None)]


def test_lines_of_split_files(spark, folder):
    """Lines are right wherever the file is cut into blocks."""
    put(f"{folder}/in/a.csv", "k,v\n" + "".join(f"{i},x\n" if i % 97 else f"{i}\n" for i in range(1, 3000)))
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
        got = K.checked_delimited(spark, f"{folder}/in", ["k", "v"])
        assert got.rdd.getNumPartitions() > 4
        assert [(x[1], x[3]) for x in bad(got, spark, f"{folder}/in")] == [(i + 1, str(i)) for i in range(97, 3000, 97)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)


def test_fixed_width(spark, folder):
    put(f"{folder}/in/a.txt", "ab 12\nxé 34   \nab\nab 12 z\n\nab 1\n", "iso-8859-1")
    layout = [FixedField(1, 3, "a"), FixedField(4, 2, "b")]
    got = K.checked_fixed_width(spark, f"{folder}/in", layout)
    assert rows(got.filter("NOT _has_violation").select("a", "b")) == [("ab", "12"), ("xé", "34")]
    assert [x[1:3] for x in bad(got, spark, f"{folder}/in")] == [(3, "short"), (4, "long"), (6, "short")]
    loose = K.checked_fixed_width(spark, f"{folder}/in", layout, padded=False)
    assert [x[1:3] for x in bad(loose, spark, f"{folder}/in")] == [(3, "short"), (4, "long")]


def test_preamble_files_with_their_own_headers(spark, folder):
    put(f"{folder}/in/a.csv", "notes, many\nK,YEAR,V\n1,2020,x\n2,2020\n")
    put(f"{folder}/in/b.csv", "V,K\ny,3\n,4\nz,5,6\n")
    got = K.checked_csv_with_preamble(spark, f"{folder}/in", ["K"])
    assert rows(got.filter("NOT _has_violation").select("K", "YEAR", "V")) == [("1", "2020", "x"), ("3", None, "y"), ("4", None, None)]
    assert [x[:3] for x in bad(got, spark, f"{folder}/in")] == [("a.csv", 4, "short"), ("b.csv", 4, "long")]
    put(f"{folder}/in/c.csv", "nothing\n")
    with pytest.raises(ValueError, match="c.csv"):
        K.checked_csv_with_preamble(spark, f"{folder}/in", ["K"])


def test_json_matrix(spark):
    data = [("p1", '[["a","b"],["1","2"],["3"],null,["4","5","6"],[null,"7"]]'), ("p2", '{"error":1}'), ("p3", '[["a","x"],["1","2"]]'), ("p4", None), ("p5", "[]"),
            ("p6", '[["b","a"]]')]
    got = K.checked_json_matrix(spark.createDataFrame(data, "path string, body string"), "body", ["a", "b"], "path")
    assert rows(got.filter("NOT _has_violation").select("a", "b", "line")) == [("1", "2", 2), (None, "7", 6)]
    assert rows(got.filter("_has_violation").select("_file", "line", "_reason"), "_file", "line") == [
        ("p1", 3, "short"), ("p1", 4, "short"), ("p1", 5, "long"), ("p2", 0, "unparsable"), ("p3", 0, "no header"), ("p4", 0, "unparsable"), ("p5", 0, "no header")]


def test_json_records(spark, folder):
    lines = ['{"n":1,"s":"x","d":"2024-01-02"}', '{"s":5,"n":"7","more":{"q":1}}', '[{"n":2},{"n":true},3]', '{"n":1', '', '{"n":"x"}', "null", '{"it\'s":1,"n":null}']
    put(f"{folder}/in/a.json", "\n".join(lines))
    ddl = "n int, s string, d date"
    got = K.checked_json_records(spark, f"{folder}/in", ddl)
    good = rows(got.filter("NOT _has_violation").select("n", "s"))
    assert good == [(1, "x"), (1, None), (2, None), (7, "5"), (None, None)]
    assert [x[1:3] for x in bad(got, spark, f"{folder}/in")] == [(3, "not an object"), (4, "unparsable"), (6, "type:n"), (7, "not an object")]
    assert rows(K.unseen_fields(K.json_records(spark, f"{folder}/in"), ddl)) == [("it's", 1), ("more", 1)]
    quoted = K.checked_json_records(spark, f"{folder}/in", "`it's` bigint")
    assert [r[0] for r in quoted.filter("`it's` = 1").select("`it's`").collect()] == [1]
    assert plan_of(got).count("FileScan") == 1


def executions(spark, run):
    store = spark._jsparkSession.sharedState().statusStore()
    before = store.executionsCount()
    out = run()
    return out, store.executionsCount() - before


def test_a_split_is_one_pass(spark, folder):
    """Counts and the gate come out of the write itself; a stopped batch leaves the date as it was, and nothing behind."""
    data = lambda n: spark.range(100).selectExpr("id", f"id < {n} AS _has_violation")
    counts, n = executions(spark, lambda: W.write_split(data(10), folder, "s", "2024-01-01", max_bad_rate=0.2))
    assert (counts.total_rows, counts.clean_rows, counts.quarantine_rows, n) == (100, 90, 10, 1)

    def stopped():
        with pytest.raises(TooManyBadRows) as e:
            W.write_split(data(21), folder, "s", "2024-01-01", max_bad_rate=0.2)
        return e.value

    e, n = executions(spark, stopped)
    assert (e.total, e.bad, n) == (100, 21, 1)
    assert spark.read.schema("id long, route string").parquet(f"{folder}/s").filter("route = 'quarantine'").count() == 10
    assert sorted(os.listdir(folder)) == ["s"]
    empty, _ = executions(spark, lambda: W.write_split(data(1).limit(0), folder, "s", "2024-01-01", max_bad_rate=0.2))
    assert empty.total_rows == 0
    unknown = spark.range(4).selectExpr("id", "CASE WHEN id = 1 THEN TRUE END AS _has_violation")
    assert W.write_split(unknown, folder, "u", "2024-01-01").quarantine_rows == 1


def test_landed_records(spark, folder):
    put(f"{folder}/in/a.json", '{"k":1}\n{"k":\n{"k":"x"}\n')
    rows_ = K.checked_json_records(spark, f"{folder}/in", "k int, z string")
    counts = W.land_checked(rows_, f"{folder}/good", f"{folder}/bad")
    assert (counts.clean_rows, counts.quarantine_rows) == (1, 2)
    assert rows(spark.read.schema("k int").parquet(f"{folder}/good")) == [(1,)]
    assert sorted(r["_reason"] for r in spark.read.parquet(f"{folder}/bad").collect()) == ["type:k", "unparsable"]
    with pytest.raises(TooManyBadRows):
        W.land_checked(rows_, f"{folder}/good", f"{folder}/bad", 0.5)
    with pytest.raises(ValueError, match="z"):
        W.land_checked(rows_, f"{folder}/good", f"{folder}/bad", required=["k", "z"])
    assert spark.read.parquet(f"{folder}/good").count() == 1
    W.land_checked(rows_.filter("_has_violation"), f"{folder}/good", f"{folder}/bad")
    assert spark.read.parquet(f"{folder}/good").count() == 0


def test_raw_files_to_population_dimension(spark, folder):
    """Census payloads, fixed-width and delimited resources, rural codes: through bronze and silver to the dimension."""
    landed, base, out, day = f"{folder}/landed", f"{folder}/bronze", f"{folder}/silver", "2024-05-10"
    params = RunParams(day)
    names = ["state", "county", *CENSUS_COLUMNS, *AGE_65_PLUS]
    values = {"B01001_001E": "1000", "B17001_001E": "900", "B17001_002E": "90"}
    row = lambda state, county: [state, county, *[values.get(n, "5") for n in names[2:]]]
    for year in (2021, 2022):
        put(f"{landed}/census/acs_{year}/data.json", json.dumps([names, *[row("01", f"{2 * i + 1:03d}") for i in range(9)], ["01", "003"]]))
    put(f"{landed}/resources/ahrf_2021/data/a.asc", "01001  7\n01003  9\n")
    put(f"{landed}/resources/ahrf_2021/layout/l.sas", "@00001 a $ 2. /*f00011*/\n@00003 b $ 3. /*f00012*/\n@00006 c 3. /*F1130819*/\n")
    put(f"{landed}/resources/ahrf_2022/a.csv", "F00011,F00012,F1130819\n01,001,20\n")
    put(f"{landed}/rural/{day}/a.csv", "FIPS,State,County_Name,Attribute,Value\n1001,AL,Autauga,RUCC_2023,2\n1001,AL,Autauga,Description,Metro\n")
    for job in ("census", "resources", "rural"):
        bronze.JOBS[job](spark, params, landed, base)
    assert spark.read.parquet(f"{base}/population/census/{day}").count() == 18
    assert [r["_reason"] for r in spark.read.parquet(f"{base}/malformed/census_2021/{day}").collect()] == ["short"]
    resources = spark.read.parquet(f"{base}/population/resources/{day}")
    assert rows(resources.select("data_year", "f00012", "f1130819")) == [(2021, "001", "7"), (2021, "003", "9"), (2022, "001", "20")]
    geo = f"{base}/geography"
    spark.createDataFrame([("01001", "Autauga County", "Alabama", "AL")], "county_fips string, county_name string, state_name string, state_code string").write.parquet(f"{geo}/names/{day}")
    spark.createDataFrame([("01001", 10.0)], "county_fips string, area_km2 double").write.parquet(f"{geo}/area/{day}")
    spark.createDataFrame([("01001", "AL-X")], "county_fips string, hrr_region string").write.parquet(f"{geo}/region/{day}")
    silver.run_geography(spark, params, base, out)
    assert silver.run_population(spark, params, base, out).clean_rows == 18
    found = gold.dim_population(gold._routed(spark, out, "population", schemas.EXT_POPULATION, day))
    got = {(r["county_fips"], r["census_year"]): r for r in found.collect()}
    one = got["01001", 2022]
    assert (one["total_population"], one["poverty_rate_pct"], one["population_density"], one["rucc_code"]) == (1000, 10.0, 100.0, 2)
    assert one["physicians_per_100k"] == 2000.0 and got["01003", 2021]["physicians_per_100k"] == 900.0


def test_flu_files(spark, folder):
    landed, base, day = f"{folder}/landed", f"{folder}/bronze", "2024-05-10"
    body = "".join(f"{c},{s},2021,10,Overall,Overall,Overall,Overall,1.5\n" for c in ("Entire Network", "Georgia", "Ohio") for s in ("2020-21",))
    put(f"{landed}/flu_surveillance/{day}/a.csv", "Some notes\nCATCHMENT,YEAR,YEAR,WEEK,AGE CATEGORY,SEX CATEGORY,RACE CATEGORY,VIRUS TYPE CATEGORY,WEEKLY RATE\n" + body + "Utah,2020-21\n" )
    put(f"{landed}/flu_activity/{day}/a.csv", "STATENAME,ACTIVITY LEVEL,ACTIVITY LEVEL LABEL,WEEKEND,WEEK,SEASON\nnew york,3,High,Mar-05-2022,9,2021-22\nohio,2,Low,Mar-05-2022,9,2021-22\n")
    params = RunParams(day)
    with pytest.raises(TooManyBadRows):
        bronze.run_flu(spark, params, landed, base)
    put(f"{landed}/flu_surveillance/{day}/b.csv", "CATCHMENT,YEAR,YEAR,WEEK,AGE CATEGORY,SEX CATEGORY,RACE CATEGORY,VIRUS TYPE CATEGORY,WEEKLY RATE\n" + body)
    bronze.run_flu(spark, params, landed, base)
    assert spark.read.parquet(f"{base}/flu/national/{day}").count() == 2 and spark.read.parquet(f"{base}/flu/states/{day}").count() == 4
    assert sorted(r["state_name"] for r in spark.read.parquet(f"{base}/flu/activity/{day}").collect()) == ["New York", "Ohio"]
    assert [r["_reason"] for r in spark.read.parquet(f"{base}/malformed/flu_surveillance/{day}").collect()] == ["short"]
