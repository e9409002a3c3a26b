from __future__ import annotations

import datetime

from conftest import rows
from pyspark.sql import functions as F

from wardmill.functions import cleaning as C
from wardmill.functions import measures as M

c = F.col


def values(spark, texts, expr, dtype="string"):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], f"i int, t {dtype}")
    return [r[1] for r in df.select("i", expr.alias("x")).orderBy("i").collect()]


def test_missing_texts_become_null_before_any_cast(spark):
    assert values(spark, ["nan", "None", "NaN", "", " ", None, "1.5", "x"], C.to_double(c("t"))) == [
        None, None, None, None, None, None, 1.5, None
    ]


def test_clean_numeric_keeps_digits_dot_and_minus(spark):
    df = spark.createDataFrame([("1,234",), ("",), (None,), ("$-5.5 ",), ("1-2",), ("abc",)], "v string")
    got = [r[0] for r in df.select(C.clean_numeric(df, "v")).collect()]
    assert got == [1234.0, None, None, -5.5, None, None]
    assert df.select(C.clean_numeric(df, "absent").alias("x")).first()["x"] is None


def test_whole_numbers(spark):
    assert values(spark, ["3", "3.0", "3.5", "x", None, "Infinity"], C.to_integer(c("t"))) == [3, 3, None, None, None, None]


def test_rounding_goes_away_from_zero(spark):
    got = values(spark, [0.5, 1.5, 2.5, -2.5, 2.4, None], C.round_to_integer(c("t")), "double")
    assert got == [1, 2, 3, -3, 2, None]


def test_suffix_is_stripped_once_and_only_at_the_end(spark):
    texts = ["Los Angeles County", "Orleans PARISH", "Juneau borough", "Bethel Census Area", "County Line", "County", None]
    assert values(spark, texts, C.strip_suffix(c("t"))) == [
        "Los Angeles", "Orleans", "Juneau", "Bethel", "County Line", "County", None
    ]


def test_split_at_the_last_separator(spark):
    texts = ["A, B, C", "Los Angeles County, California", "none", None, ", x"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    head, tail = C.split_last(c("t"))
    assert rows(df.select("i", head, tail), "i") == [
        (0, "A, B", "C"), (1, "Los Angeles County", "California"), (2, "none", None), (3, None, None), (4, "", "x")
    ]


def test_padding_truncates_only_on_request(spark):
    assert values(spark, ["7", "12345", "123456", None], C.pad_code(c("t"), 5)) == ["00007", "12345", "123456", None]
    assert values(spark, ["7", "123456"], C.pad_code(c("t"), 5, truncate=True)) == ["00007", "12345"]


def test_codes_need_every_part(spark):
    df = spark.createDataFrame([("01", None, "02", "003"), ("01", "001", None, None), (None, None, None, None)],
                               "a string, b string, x string, y string")
    got = [r[0] for r in df.select(C.compose_code((c("a"), c("b")), (c("x"), c("y")))).collect()]
    assert got == ["02003", "01001", None]


def test_code_lookup_and_titles(spark):
    assert values(spark, ["06", "99", None], C.map_code(c("t"), {"06": "CA"})) == ["CA", None, None]
    assert values(spark, [" new york ", "GUAM"], C.title_case(c("t"))) == ["New York", "Guam"]


def test_dates_and_seasons(spark):
    assert values(spark, ["Mar-05-2022", "bad", None], C.parse_date(c("t"), "MMM-dd-yyyy")) == [
        datetime.date(2022, 3, 5), None, None
    ]
    assert values(spark, ["2020-21", "x-21", None], C.season_start(c("t"))) == [2020, None, None]


def test_sentinel(spark):
    assert values(spark, [-9999.0, 1.0, None], C.null_sentinel(c("t"), -9999), "double") == [None, 1.0, None]


def test_ratios_never_divide_by_zero(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, 3.0), (None, 2.0), (1.0, -1.0)], "a double, b double")
    got = rows(df.select(M.safe_div(c("a"), c("b")), M.pct_of(c("a"), c("b")), M.per_100k(c("a"), c("b"))))
    assert sorted(map(str, got)) == sorted(map(str, [
        (None, None, None), (1 / 3, 33.3333, 33333.3333), (None, None, None), (-1.0, None, None)
    ]))


def test_clip_and_interval_keep_null(spark):
    low, high = M.interval(c("t"))
    assert values(spark, [None, 0.02, 0.98, 0.5], low, "double")[:2] == [None, 0.0]
    assert values(spark, [None, 0.02, 0.98, 0.5], high, "double")[2] == 1.0
    assert values(spark, [None, -1.0, 2.0], M.clip(c("t"), 0.0, 1.0), "double") == [None, 0.0, 1.0]


def test_alert_boundary_is_a_choice(spark):
    assert values(spark, [0.9], M.alert_flag(c("t")), "double") == [True]
    assert values(spark, [0.9], M.alert_flag(c("t"), inclusive=False), "double") == [False]


def test_labels(spark):
    assert values(spark, [0.9, 0.7, 0.69, None], M.status_label(c("t")), "double") == [
        "CRITICAL", "WARNING", "NORMAL", "NORMAL"
    ]
    assert values(spark, [3, 4, 9, 10, None], M.metro_flag(c("t")), "int") == ["Metro", "Non-Metro", "Non-Metro", None, None]
