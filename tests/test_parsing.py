"""Tolerant parsing and labels."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyfield.functions import labels, parsing
from tallyfield.plans import schemas as S


def column(spark, values, expression):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [row[0] for row in rows.orderBy("i").select(expression(F.col("v"))).collect()]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_parse_int_cuts_a_decimal_tail(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    values = ["12", " 12 ", "12.0", "12.7", "-12.7", ".5", "12.", "", "abc", None, "1e3", "12.x", "99999999999"]
    want = [12, 12, 12, 12, -12, 0, 12, None, None, None, None, None, None]
    assert column(spark, values, parsing.parse_int) == want
    spark.conf.set("spark.sql.ansi.enabled", before)


def test_long_ids_keep_every_digit(spark):
    values = ["9007199254740993", "9007199254740993.0"]
    assert column(spark, values, lambda c: parsing.parse_int(c, "long")) == [9007199254740993] * 2


def test_parse_number_and_double(spark):
    values = [" 1.5 ", "", "  ", None, "x"]
    assert column(spark, values, parsing.parse_number) == [1.5, None, None, None, None]
    assert column(spark, ["41.5", "abc", ""], parsing.parse_double) == [41.5, None, None]


def test_parse_bool(spark):
    values = ["T", " yes ", "1", "TRUE", "f", "No", "0", "maybe", "", None]
    want = [True, True, True, True, False, False, False, None, None, None]
    assert column(spark, values, parsing.parse_bool) == want


def test_each_timestamp_format(spark):
    values = [
        "01/02/2012 01:30:00 PM",
        "01/02/2012 13:30:00",
        "2012-01-02 13:30:00",
        "2012-01-02",
        "01/02/2012 01:30:00 pm",
        "13/02/2012 01:30:00 PM",
        "2012-02-30",
        "2012-1-2",
        "not-a-date",
        "",
        None,
    ]
    noon = dt.datetime(2012, 1, 2, 13, 30)
    want = [noon, noon, noon, dt.datetime(2012, 1, 2), noon] + [None] * 6
    parsed = column(spark, values, lambda c: parsing.parse_timestamp(c, S.INCIDENTS.timestamp_formats).cast("string"))
    assert parsed == [str(w) if w else None for w in want]


def test_the_shape_rejects_nothing_that_a_format_accepts(spark):
    days = spark.range(0, 20000, 7).select(F.timestamp_seconds(F.col("id") * 86399).alias("ts"))
    for fmt in (*S.INCIDENTS.timestamp_formats, *S.WEATHER.timestamp_formats):
        text = days.select(F.date_format("ts", fmt).alias("v"))
        guarded = text.select("v", parsing.parse_timestamp(F.col("v"), [fmt]).alias("a"))
        plain = guarded.withColumn("b", F.try_to_timestamp("v", F.lit(fmt)))
        assert plain.filter("a IS NULL OR NOT a <=> b").count() == 0


def test_spring_forward_hour_moves_on(spark, zone):
    zone("America/Chicago")
    parse = lambda c: F.hour(parsing.parse_timestamp(c, S.WEATHER.timestamp_formats))
    assert column(spark, ["2010-03-14T02:00", "2010-03-14T03:00"], parse) == [3, 3]


def test_weather_codes(spark):
    code = lambda c: labels.map_codes(
        c.cast("int"), S.WEATHER_CODES, S.QUIET, S.WEATHER.code_above
    )
    got = column(spark, ["95", "71", "61", "48", "0", "3", "4", "-1", None], code)
    quiet, other = "no_reported_weather", "other_reported_weather"
    assert got == ["thunderstorm", "snow", "rain", "fog_or_mist", quiet, quiet, other, quiet, quiet]


def test_rejection_reason_joins_failed_rules_only(spark):
    rows = spark.createDataFrame([(True, True), (False, True), (False, False)], "a boolean, b boolean")
    got = rows.select(labels.rejection_reason({"bad_a": "a", "bad_b": "b"})).collect()
    assert [row[0] for row in got] == ["", "bad_a", "bad_a,bad_b"]
