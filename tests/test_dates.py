"""new Date(text) and Number(x) as JavaScript reads them."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from innkeeper.functions import jsvalue as js
from innkeeper.operators import records

DATES = {
    "2024-01-02": "2024-01-02 00:00:00", "2024-01-02T10:11:12.000Z": "2024-01-02 10:11:12", "2024": "2024-01-01 00:00:00",
    "2024-03": "2024-03-01 00:00:00", "2024-01-02T10:11:12+02:00": "2024-01-02 08:11:12", "2024-01-02 10:11": "2024-01-02 10:11:00",
    "1/2/2024": "2024-01-02 00:00:00", "2024/1/2": "2024-01-02 00:00:00", "Jan 2 2024": "2024-01-02 00:00:00",
    "Jan 2, 2024": "2024-01-02 00:00:00", "2 January 2024": "2024-01-02 00:00:00", "January 2024": "2024-01-01 00:00:00",
    "Tue, 02 Jan 2024 10:00:00 GMT": "2024-01-02 10:00:00", "January 2, 2024 3:04 PM": "2024-01-02 15:04:00",
    "Jan 2 2024 10:00 GMT+0200": "2024-01-02 08:00:00", "2/30/2024": "2024-03-01 00:00:00", "Jan 2 99": "1999-01-02 00:00:00",
    "Tue Jan 02 2024 12:00:00 GMT+0100 (CET)": "2024-01-02 11:00:00", "1/2/2024 12:30 AM": "2024-01-02 00:30:00",
    "12:30": None, "not a date": None, "2024-02-30": None, "13/13/2024": None, "": None, "Jan": None, "2024-01-02T25:00": None,
    "Jan 2 2024 at noon": None,
}


def test_dates(spark):
    df = spark.createDataFrame([(k,) for k in DATES], "s string").select("s", js.js_parse_date(F.col("s")).cast("string").alias("d"))
    assert {r.s: r.d for r in df.collect()} == DATES


@pytest.mark.parametrize("text,value", [("5", 5.0), ('"0x1F"', 31.0), ('"0x' + "f" * 40 + '"', float(16 ** 40 - 1)), ("[]", 0.0),
                                        ("[5]", 5.0), ('["7"]', 7.0), ("[null]", 0.0), ('" 8 "', 8.0), ("true", 1.0), ("null", 0.0)])
def test_numbers(spark, text, value):
    r = spark.range(1).select(js.js_number(F.parse_json(F.lit(text))).alias("n")).first().n
    assert r == pytest.approx(value)


@pytest.mark.parametrize("text", ["[1,2]", "{}", '"x"', "[[1,2]]", '"8.5abc"'])
def test_not_numbers(spark, text):
    assert spark.range(1).select(F.isnan(js.js_number(F.parse_json(F.lit(text)))).alias("n")).first().n


def test_time_only_dates_reject_and_deep_lines_say_so(spark):
    deep = "[" * 1500 + "]" * 1500
    lines = spark.createDataFrame([("f", 0, deep), ("f", 1, "{bad")], "file string, i int, value string").select(
        "file", F.struct("i").alias("ord"), "value")
    assert sorted(r.errors[0] for r in records.check_lines(lines).collect()) == ["Invalid JSON format", "JSON nested too deep"]
    assert dt.datetime(1970, 1, 1) == spark.range(1).select(js.js_date(F.parse_json(F.lit('""')))).first()[0]
