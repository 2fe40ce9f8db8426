"""Hourly and daily series, summary tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyfield.operators import explore, quality, series
from tallyfield.plans import jobs, schemas as S


def weather(spark, *rows):
    names = ", ".join(f"{c} string" for c in S.WEATHER.required)
    return spark.createDataFrame(list(rows), names)


def test_two_rows_in_one_hour(spark):
    raw = weather(
        spark,
        (" cell ", "2012-01-02T12:10", "40", "0.00", "80", "10", "71"),
        ("cell", "2012-01-02T12:50", "42", "0.10", "", "12", "61"),
    )
    hourly = jobs.hourly_weather(raw)
    row = hourly.first()
    assert (row.weather_hour, row.hourly_precipitation_inches, row.average_temperature_f) == (12, 0.1, 41.0)
    assert row.average_relative_humidity == 80.0 and row.weather_station == "cell"
    flags = (row.has_precipitation, row.has_snow, row.has_rain, row.has_thunderstorm)
    assert flags == (1, 1, 1, 0) and hourly.columns == list(S.HOURLY_COLUMNS)
    metrics = quality.series_quality(raw, jobs.weather_time(), hourly, ("weather_station", "weather_date")).first()
    assert tuple(metrics)[:4] == (2, 0, 1, 1)


def test_hour_without_incidents_counts_zero(spark):
    raw = weather(
        spark,
        ("c", "2012-01-02T12:10", "40", "0.00", "80", "10", "0"),
        ("c", "2012-01-02T13:10:00", "42", "0.20", "80", "12", "61"),
    )
    facts = spark.createDataFrame([("2012-01-02 12:05:00",)] * 2, "t string")
    facts = facts.select(F.col("t").cast("timestamp").alias("incident_timestamp"))
    daily = jobs.daily_weather(facts, jobs.hourly_weather(raw))
    row = daily.first()
    assert (row.crime_count, row.has_rain, row.has_precipitation) == (2, 1, 1)
    impact = explore.condition_impact(daily, jobs.condition(), "crime_count", "weather_condition").first()
    assert (impact.weather_condition, impact.day_count) == ("rain", 1)


def test_missing_weather_column_fails(spark):
    with pytest.raises(ValueError, match="missing required columns"):
        series.prepare_series(spark.createDataFrame([("c",)], "weather_location string"), S.WEATHER)


def impact_rows(spark, *rows):
    return spark.createDataFrame(list(rows), "weather_condition string, average_daily_crime_count double")


def effects(df):
    return explore.effect_sizes(df, "weather_condition", S.NO_EVENT, "average_daily_crime_count")


def test_effect_sizes(spark):
    got = effects(impact_rows(spark, ("no event", 10.0), ("rain", 12.0))).orderBy("weather_condition").collect()
    assert [(r.absolute_difference_from_no_event, r.percent_difference_from_no_event) for r in got] == [
        (0.0, 0.0),
        (2.0, 20.0),
    ]


def test_effect_sizes_without_baseline_have_no_rows(spark):
    assert effects(impact_rows(spark, ("rain", 12.0))).count() == 0


def test_effect_sizes_of_a_zero_baseline_have_no_percent(spark):
    got = effects(impact_rows(spark, ("no event", 0.0), ("rain", 1.0))).collect()
    assert {r.percent_difference_from_no_event for r in got} == {None}


def test_spine_has_observed_days_only(spark):
    days = spark.createDataFrame([(dt.date(2012, 1, d),) for d in (1, 2, 5)], "day date")
    keys = spark.createDataFrame([(1,), (2,)], "area int")
    got = series.spine(keys, "area", days, "day")
    assert sorted((r.area, r.day.day) for r in got.collect()) == [(a, d) for a in (1, 2) for d in (1, 2, 5)]


def test_rolling_mean_starts_with_the_rows_there_are(spark):
    rows = spark.createDataFrame([(1, d, float(d)) for d in range(1, 10)], "a int, d int, v double")
    got = series.rolling_mean(rows, "a", "d", "v", 7, "m").orderBy("d").collect()
    assert [r.m for r in got] == [1.0, 1.5, 2.0, 2.5, 3.0, 3.5, 4.0, 5.0, 6.0]


def test_period_includes_both_ends(spark):
    days = spark.createDataFrame([(dt.date(2012, 1, 2),), (dt.date(2012, 1, 3),)], "day date")
    times = ["2012-01-01 23:59:59", "2012-01-02 00:00:00", "2012-01-03 23:59:59", "2012-01-04 00:00:00"]
    rows = spark.createDataFrame([(t,) for t in times], "t string").select(F.col("t").cast("timestamp").alias("ts"))
    rows = rows.withColumn("year", F.year("ts"))
    for year in (None, "year"):
        kept = series.within_period(rows, "ts", series.period(days, "day"), year)
        assert sorted(str(r.ts) for r in kept.collect()) == times[1:3]


def test_weekday_table_from_patterns_equals_the_one_from_facts(spark, tables):
    facts = tables.facts()
    patterns = explore.temporal_patterns(facts, "incident_timestamp", "crime_count")
    a = explore.weekday_weekend(facts, "incident_timestamp", "crime_count")
    assert a.exceptAll(explore.weekday_totals(patterns, "crime_count")).count() == 0


def test_stddev_of_one_day_is_null(spark):
    rows = spark.createDataFrame([(dt.date(2012, 7, 1), 3)], "weather_date date, crime_count int")
    rows = rows.withColumns({flag: F.lit(0) for flag in S.CONDITIONS})
    row = explore.seasonal_impact(rows, jobs.condition(), "weather_date", "crime_count", "weather_condition").first()
    assert (row.season, row.weather_condition, row.crime_count_standard_deviation) == ("summer", "no event", None)


def test_correlation_ignores_incomplete_pairs_and_constants(spark):
    rows = [(1, 2.0, 5.0), (2, 4.0, 5.0), (3, None, 5.0), (4, 7.0, 5.0), (None, 100.0, 5.0)]
    df = spark.createDataFrame(rows, "n int, x double, c double")
    row = explore.correlations(df, "n", {"x": "x", "c": "c"}).first()
    want = df.dropna().corr("n", "x")
    assert row.x == pytest.approx(want) and row.c is None
    assert explore.correlations(df.limit(1), "n", {"x": "x"}).first().x is None


def test_rolling_sums_equal_a_window_over_the_dense_table(spark):
    days = spark.sql("SELECT explode(array(date'2020-01-01', date'2020-01-02', date'2020-01-05', date'2020-01-09', date'2020-01-10')) AS d")
    keys = spark.range(4).select(F.col("id").cast("int").alias("k"))
    counts = spark.sql("""SELECT int(k) AS k, d, bigint(c) AS c FROM VALUES (0, date'2020-01-01', 5), (0, date'2020-01-05', 7), (1, date'2020-01-10', 2),
        (2, date'2020-01-03', 9), (9, date'2020-01-02', 4), (3, NULL, 1), (0, date'2020-01-09', 1) AS t(k, d, c)""")
    dense = series.densify(counts.filter("d IS NOT NULL"), series.spine(keys, "k", days, "d"), ["k", "d"], "c")
    want = series.rolling_mean(dense, "k", "d", "c", 3, "m").select("k", "d", "c", "m").collect()
    got = series.rolling_dense(counts, keys, days, "k", "d", "c", 3, "m").collect()
    assert len(got) == 20 and sorted(map(tuple, got)) == sorted(map(tuple, want))


def test_rolling_work_grows_with_the_counts(spark):
    """100,000 keys over 400 days, of which 50 keys have counts."""
    days = spark.range(400).select(F.date_add(F.lit("2020-01-01").cast("date"), F.col("id").cast("int")).alias("d"))
    counts = spark.range(50).select(F.col("id").alias("k"), F.lit("2020-03-01").cast("date").alias("d"), F.lit(7).alias("c"))
    sums = series.rolling_sums(counts, series.numbered_days(days, "d"), "k", "d", "c", 7)
    assert sums.count() == 350 and sums.agg(F.sum("c"), F.sum("_sum")).first()[:] == (350, 7 * 350)
    keys = spark.range(100_000).select(F.col("id").alias("k"))
    some = series.rolling_dense(counts, keys, days, "k", "d", "c", 7, "m")
    text = some._jdf.queryExecution().optimizedPlan().toString()
    assert "windowspecdefinition(d#" in text and "windowspecdefinition(k#" not in text
    busy = some.filter("k % 20000 = 0 OR k = 49").filter("m > 0")
    assert busy.count() == 14 and busy.agg(F.min("m"), F.max("m")).first()[:] == (1.0, 1.0)


def test_a_day_sum_that_is_constant_but_for_rounding_has_no_correlation(spark):
    hours = [(d, h, 0.1, d * h % 7) for d in range(40) for h in range(24)]
    rain = spark.createDataFrame(hours, "day long, hour long, rain double, crimes long").repartition(7, "day", "hour")
    daily = rain.groupBy("day").agg(F.sum("rain").alias("rain"), F.sum("crimes").alias("crimes"))
    daily = daily.withColumn("rain", F.when(F.col("day") % 3 == 0, F.lit(2.4000000000000004)).otherwise(F.col("rain")))
    daily = daily.withColumn("twice", F.col("crimes") * 2.0)
    row = explore.correlations(daily, "crimes", {"rain": "rain", "twice": "twice"}).first()
    assert row["rain"] is None and row["twice"] == pytest.approx(1.0)
