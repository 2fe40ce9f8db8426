"""Queries on hourly, daily, seasonal and area tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.labels import day_type, season
from ..operators import explore, series, shares
from ..operators.ordering import ordered
from ..operators.scalars import distinct_values, with_scalar
from ..plans import jobs, schemas as S
from .registry import query
from .standins import (
    CONDITION_SQL,
    DAILY_SQL,
    DAILY_WEATHER_SQL,
    EVENT_FACTS_SQL,
    FACTS_SQL,
    HOURLY_WEATHER_SQL,
    IMPACT_SQL,
    LOOKUP_SQL,
    MODEL_TABLE_SQL,
    SERIES_YEARS,
    Tables,
)

TS, COUNT = "incident_timestamp", "crime_count"
HOURLY_FLOATS = [
    "average_temperature_f",
    "hourly_precipitation_inches",
    "average_relative_humidity",
    "average_wind_speed_mph",
]
DAILY_FLOATS = [
    "average_temperature_f",
    "average_relative_humidity",
    "average_wind_speed_mph",
    "reported_precipitation_inches",
]
AREA = ["community_name", "hardship_index"]
YEARS = (1997, 1998)
SEASON_SQL = """CASE WHEN month({0}) IN (12, 1, 2) THEN 'winter' WHEN month({0}) IN (3, 4, 5) THEN 'spring'
    WHEN month({0}) IN (6, 7, 8) THEN 'summer' ELSE 'autumn' END"""
PATTERNS_SQL = f"""{EVENT_FACTS_SQL}, patterns AS (
    SELECT year, month, day_of_week, hour, count(*) AS crime_count FROM facts
    WHERE incident_timestamp IS NOT NULL GROUP BY ALL)"""
PERIOD_SQL = f"""{DAILY_SQL}, {LOOKUP_SQL},
    series_days AS (SELECT * FROM daily WHERE year(weather_date) BETWEEN {SERIES_YEARS[0]} AND {SERIES_YEARS[1]}),
    located AS (SELECT * FROM facts WHERE has_valid_community_area
        AND incident_timestamp::DATE BETWEEN (SELECT min(weather_date) FROM series_days)
                                         AND (SELECT max(weather_date) FROM series_days))"""


SEASONAL_BODY = f"""SELECT {SEASON_SQL.format('weather_date')} AS season, {CONDITION_SQL} AS weather_condition,
        count(*) AS day_count, avg(crime_count) AS average_daily_crime_count,
        stddev_samp(crime_count) AS crime_count_standard_deviation FROM daily GROUP BY 1, 2"""
EFFECT_BODY = """SELECT *, average_daily_crime_count - no_event_average_daily_crime_count AS absolute_difference_from_no_event,
               (average_daily_crime_count - no_event_average_daily_crime_count)
                   / no_event_average_daily_crime_count * 100 AS percent_difference_from_no_event
        FROM impact, (SELECT average_daily_crime_count AS no_event_average_daily_crime_count FROM impact
                      WHERE weather_condition = 'no event')"""
CORRELATION_BODY = f"SELECT {', '.join(f'corr(crime_count, {c}) AS {name}' for name, c in S.CORRELATIONS.items())} FROM daily"
ROLLING_BODY = """SELECT weather_date, community_area, community_name, hardship_index, crime_count,
        avg(crime_count) OVER (PARTITION BY community_area ORDER BY weather_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)
            AS rolling_7_day_crime_average FROM dense JOIN lookup USING (community_area)"""
AREA_BODY = """SELECT community_area, community_name, hardship_index, count(*) AS crime_count,
        avg(arrest::INTEGER) AS arrest_rate FROM located JOIN lookup USING (community_area)
        WHERE year BETWEEN {} AND {} GROUP BY ALL"""
SPATIAL_BODY = """SELECT community_area, community_name, count(*) AS crime_count,
               count(*) / (SELECT count(*) FROM located WHERE has_valid_coordinates) AS crime_share,
               avg(latitude) AS centroid_latitude, avg(longitude) AS centroid_longitude, hardship_index
        FROM located JOIN lookup USING (community_area) WHERE has_valid_coordinates
        GROUP BY community_area, community_name, hardship_index"""
WEEKDAY_BODY = """SELECT CASE WHEN day_of_week IN (1, 7) THEN 'weekend' ELSE 'weekday' END AS day_type,
        hour, count(*) AS crime_count FROM facts WHERE incident_timestamp IS NOT NULL GROUP BY 1, 2"""
PATTERNS_BODY = """SELECT year, month, day_of_week, hour, count(*) AS crime_count FROM facts
        WHERE incident_timestamp IS NOT NULL GROUP BY ALL"""
DENSE_SQL = """
    area_counts AS (SELECT community_area, incident_timestamp::DATE AS weather_date, count(*) AS crime_count
                    FROM facts WHERE has_valid_community_area GROUP BY ALL),
    area_days AS (SELECT community_area, weather_date FROM lookup, daily),
    dense AS (SELECT community_area, weather_date, coalesce(crime_count, 0) AS crime_count
              FROM area_days LEFT JOIN area_counts USING (community_area, weather_date))"""


def impact(t: Tables):
    return explore.condition_impact(t.daily_weather(), jobs.condition(), COUNT, "weather_condition")


def patterns(t: Tables):
    return explore.temporal_patterns(t.event_facts(), TS, COUNT)


@query(
    "p10_priority_label",
    f"WITH {DAILY_SQL} SELECT weather_date, {CONDITION_SQL} AS weather_condition FROM daily",
    dates=["weather_date"],
)
def p10_priority_label(t: Tables):
    return t.daily().select("weather_date", jobs.condition().alias("weather_condition"))


@query("p11_season", f"SELECT o_orderkey, {SEASON_SQL.format('o_orderdate')} AS season FROM orders")
def p11_season(t: Tables):
    return t.read("orders").select("o_orderkey", season(F.to_date("o_orderdate")).alias("season"))


@query(
    "p12_day_type",
    """SELECT event_id, CASE WHEN dayofweek(ts) IN (0, 6) THEN 'weekend' ELSE 'weekday' END AS day_type FROM events""",
)
def p12_day_type(t: Tables):
    return t.read("events").select("event_id", day_type(F.dayofweek("ts")).alias("day_type"))


@query(
    "f6_within_period",
    f"WITH {PERIOD_SQL} SELECT crime_id, incident_timestamp, community_area FROM located",
    times=["incident_timestamp"],
)
def f6_within_period(t: Tables):
    kept = t.facts().filter("has_valid_community_area")
    return series.within_period(kept, TS, series.period(t.series_days(), "weather_date")).select(
        "crime_id", TS, "community_area"
    )


@query(
    "j1_join_hourly",
    f"WITH {DAILY_WEATHER_SQL} SELECT * FROM joined",
    floats=HOURLY_FLOATS,
    dates=["weather_date"],
)
def j1_join_hourly(t: Tables):
    day, hour = S.HOURLY_WEATHER.keys
    counts = series.hourly_counts(t.event_facts(), TS, day, hour, COUNT)
    return series.join_hourly(t.hourly_weather(), counts, [day, hour], COUNT)


AREA_COUNTS_SQL = f"{DAILY_SQL}, {LOOKUP_SQL}, {DENSE_SQL}"


@query("j2_densify", f"WITH {AREA_COUNTS_SQL} SELECT * FROM dense", dates=["weather_date"])
def j2_densify(t: Tables):
    counts = (
        t.facts()
        .filter("has_valid_community_area")
        .groupBy("community_area", F.to_date(TS).alias("weather_date"))
        .agg(F.count("*").alias(COUNT))
    )
    calendar = series.spine(t.lookup(), "community_area", t.daily(), "weather_date")
    return series.densify(counts, calendar, ["community_area", "weather_date"], COUNT)


@query(
    "j3_enrich",
    f"""WITH {FACTS_SQL}, {LOOKUP_SQL} SELECT community_area, crime_id, community_name, hardship_index
        FROM facts JOIN lookup USING (community_area)""",
    floats=["hardship_index"],
)
def j3_enrich(t: Tables):
    facts = t.facts().select("community_area", "crime_id")
    return series.enrich(facts, t.lookup().select("community_area", *AREA), "community_area")


@query("j4_spine", f"WITH {AREA_COUNTS_SQL} SELECT * FROM area_days", dates=["weather_date"])
def j4_spine(t: Tables):
    return series.spine(t.lookup(), "community_area", t.daily(), "weather_date")


@query(
    "j5_with_scalar",
    """SELECT o_orderpriority, count(*) AS orders, sum(count(*)) OVER () AS total_orders
       FROM orders GROUP BY o_orderpriority""",
    longs=["total_orders"],
)
def j5_with_scalar(t: Tables):
    counts = t.read("orders").groupBy("o_orderpriority").agg(F.count("*").alias("orders"))
    return with_scalar(counts, counts.agg(F.sum("orders").alias("total_orders")))


@query(
    "a5_hourly_counts",
    f"WITH {DAILY_WEATHER_SQL} SELECT weather_date, weather_hour, crime_count FROM counts",
    dates=["weather_date"],
)
def a5_hourly_counts(t: Tables):
    return series.hourly_counts(t.event_facts(), TS, "weather_date", "weather_hour", COUNT)


@query(
    "a6_hourly_rollup",
    f"WITH {HOURLY_WEATHER_SQL} SELECT * FROM hourly",
    floats=HOURLY_FLOATS,
    dates=["weather_date"],
)
def a6_hourly_rollup(t: Tables):
    return t.hourly_weather()


@query(
    "a7_daily_rollup",
    f"WITH {DAILY_WEATHER_SQL} SELECT * FROM daily",
    floats=DAILY_FLOATS,
    dates=["weather_date"],
)
def a7_daily_rollup(t: Tables):
    return t.daily_weather()


@query("a8_condition_impact", f"WITH {IMPACT_SQL} SELECT * FROM impact", floats=["average_daily_crime_count"])
def a8_condition_impact(t: Tables):
    return impact(t)


@query(
    "a9_seasonal_impact",
    f"WITH {DAILY_SQL} {SEASONAL_BODY}",
    floats=["average_daily_crime_count", "crime_count_standard_deviation"],
)
def a9_seasonal_impact(t: Tables):
    return explore.seasonal_impact(t.daily(), jobs.condition(), "weather_date", COUNT, "weather_condition")


@query(
    "a10_effect_sizes",
    f"WITH {IMPACT_SQL} {EFFECT_BODY}",
    floats=[
        "average_daily_crime_count",
        "no_event_average_daily_crime_count",
        "absolute_difference_from_no_event",
        "percent_difference_from_no_event",
    ],
)
def a10_effect_sizes(t: Tables):
    return explore.effect_sizes(impact(t), "weather_condition", S.NO_EVENT, "average_daily_crime_count")


@query("a11_temporal_patterns", f"WITH {PATTERNS_SQL} SELECT * FROM patterns")
def a11_temporal_patterns(t: Tables):
    return patterns(t)


@query(
    "x1_sql_counts",
    f"WITH {FACTS_SQL} {PATTERNS_BODY}",
)
def x1_sql_counts(t: Tables):
    return explore.temporal_patterns(t.facts(), TS, COUNT)


@query(
    "a12_weekday_weekend",
    f"WITH {EVENT_FACTS_SQL} {WEEKDAY_BODY}",
)
def a12_weekday_weekend(t: Tables):
    return explore.weekday_weekend(t.event_facts(), TS, COUNT)


@query(
    "a12_weekday_totals",
    f"WITH {FACTS_SQL} {WEEKDAY_BODY}",
)
def a12_weekday_totals(t: Tables):
    return explore.weekday_totals(explore.temporal_patterns(t.facts(), TS, COUNT), COUNT)


@query(
    "a13_correlations",
    f"WITH {DAILY_WEATHER_SQL} {CORRELATION_BODY}",
    floats=list(S.CORRELATIONS),
)
def a13_correlations(t: Tables):
    return explore.correlations(t.daily_weather(), COUNT, S.CORRELATIONS)


@query(
    "a14_area_summary",
    f"WITH {PERIOD_SQL} {AREA_BODY.format(*YEARS)}",
    floats=["hardship_index", "arrest_rate"],
)
def a14_area_summary(t: Tables):
    bounds = series.period(t.series_days(), "weather_date")
    return explore.area_summary(
        t.facts(), t.lookup(), bounds, "community_area", "has_valid_community_area", TS, YEARS, "arrest", AREA, COUNT
    )


@query(
    "a15_spatial_profile",
    f"WITH {PERIOD_SQL} {SPATIAL_BODY}",
    floats=["crime_share", "centroid_latitude", "centroid_longitude", "hardship_index"],
)
def a15_spatial_profile(t: Tables):
    bounds = series.period(t.series_days(), "weather_date")
    flags = ["has_valid_community_area", "has_valid_coordinates"]
    return explore.spatial_profile(
        t.facts(), t.lookup(), bounds, "community_area", flags, TS, ("community_name", "hardship_index"), COUNT
    )


@query(
    "a16_period",
    f"WITH {DAILY_SQL} SELECT min(weather_date) AS period_start, max(weather_date) AS period_end FROM daily",
    dates=["period_start", "period_end"],
)
def a16_period(t: Tables):
    return series.period(t.daily(), "weather_date")


@query(
    "a26_hour_totals",
    f"WITH {PATTERNS_SQL} SELECT hour, sum(crime_count)::BIGINT AS crime_count FROM patterns GROUP BY hour",
)
def a26_hour_totals(t: Tables):
    return explore.hour_totals(patterns(t), COUNT)


@query(
    "w1_rolling_mean",
    f"WITH {AREA_COUNTS_SQL} {ROLLING_BODY}",
    floats=["hardship_index", "rolling_7_day_crime_average"],
    dates=["weather_date"],
)
def w1_rolling_mean(t: Tables):
    return explore.area_rolling(
        t.facts(),
        t.lookup(),
        t.daily(),
        "community_area",
        "has_valid_community_area",
        TS,
        "weather_date",
        COUNT,
        AREA,
        S.ROLLING_DAYS,
    )


@query(
    "r4_mean_by_condition",
    f"WITH {IMPACT_SQL} SELECT weather_condition, average_daily_crime_count FROM impact",
    floats=["average_daily_crime_count"],
)
def r4_mean_by_condition(t: Tables):
    return impact(t).select("weather_condition", "average_daily_crime_count")


@query(
    "r5_count_by_hour",
    f"""WITH {FACTS_SQL} SELECT hour, count(*) AS crime_count FROM facts
        WHERE incident_timestamp IS NOT NULL GROUP BY hour""",
    order="hour",
)
def r5_count_by_hour(t: Tables):
    return ordered(explore.hour_totals(explore.temporal_patterns(t.facts(), TS, COUNT), COUNT), "hour")


@query(
    "a21_class_distribution",
    f"""WITH {FACTS_SQL} SELECT arrest, count(*) AS count,
        round(count(*) / sum(count(*)) OVER (), 4) AS class_share FROM facts GROUP BY arrest""",
)
def a21_class_distribution(t: Tables):
    return shares.distribution(t.facts(), "arrest", "class_share")


@query(
    "a22_category_distribution",
    """SELECT p_brand, count(*) AS count, round(count(*) / sum(count(*)) OVER (), 4) AS type_share
       FROM part GROUP BY p_brand""",
    order="count DESC, p_brand",
)
def a22_category_distribution(t: Tables):
    return ordered(shares.distribution(t.read("part"), "p_brand", "type_share"), F.desc("count"), "p_brand")


TOP_SQL = """SELECT p_type, count(*) AS count, round(count(*) / sum(count(*)) OVER (), 4) AS type_share
       FROM part GROUP BY p_type ORDER BY count DESC, p_type LIMIT 10"""


@query("o3_top_categories", TOP_SQL, order="count DESC, p_type")
def o3_top_categories(t: Tables):
    return shares.top_n(shares.distribution(t.read("part"), "p_type", "type_share"), "count", "p_type", 10)


@query(
    "r6_frequent_categories",
    """SELECT p_brand, count(*) AS count FROM part GROUP BY p_brand ORDER BY count DESC, p_brand LIMIT 10""",
    order="count, p_brand",
)
def r6_frequent_categories(t: Tables):
    counts = shares.distribution(t.read("part"), "p_brand", "type_share")
    return ordered(shares.top_n(counts, "count", "p_brand", 10).select("p_brand", "count"), "count")


@query(
    "o2_ordered_by_count",
    f"""WITH {MODEL_TABLE_SQL} SELECT primary_type, count(*) AS count,
        round(count(*) / sum(count(*)) OVER (), 4) AS type_share FROM model_rows GROUP BY primary_type""",
    order="count DESC, primary_type",
)
def o2_ordered_by_count(t: Tables):
    types = shares.distribution(t.model_table(), S.MODEL.category, "type_share")
    return ordered(types, F.desc("count"), S.MODEL.category)


@query(
    "u2_distinct",
    "SELECT DISTINCT o_orderpriority, o_orderstatus FROM orders",
)
def u2_distinct(t: Tables):
    return distinct_values(t.read("orders"), "o_orderpriority", "o_orderstatus")
