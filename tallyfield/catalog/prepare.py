"""Queries on parsing, contracts, flags, rejection, dedup and quality rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.labels import map_codes
from ..functions.parsing import parse_bool, parse_number, parse_timestamp
from ..operators import contracts, quality
from ..plans import jobs, schemas as S
from ..sources import files
from .registry import query
from .standins import (
    EVENT_FACTS_SQL,
    FACTS_SQL,
    HOURLY_WEATHER_SQL,
    LOOKUP_SQL,
    OBSERVATIONS_SQL,
    PREPARED_SQL,
    Tables,
)

INVALID = ", ".join(
    f"count(*) FILTER (NOT {flag})::BIGINT AS raw_invalid_{what}_count" for what, flag in S.SOURCE_DEFECTS.items()
)
CLEAN_INVALID = ", ".join(
    f"count(*) FILTER (NOT {flag})::BIGINT AS clean_invalid_{what}_count" for what, flag in S.CLEAN_DEFECTS.items()
)


def cleaned(t: Tables, folder: str):
    """Prepared and cleaned rows, staged like in the preparation job."""
    prepared = files.stage(t.prepared(), folder, "prepared")
    return prepared, contracts.clean(prepared, S.INCIDENTS, lambda keys: files.stage(keys, folder, "repeats"))


QUALITY_BODY = f"""SELECT * FROM (SELECT count(*) AS raw_record_count, {INVALID} FROM prepared),
        (SELECT count(*) AS clean_record_count, {CLEAN_INVALID},
                count(DISTINCT crime_id) AS distinct_crime_id_count FROM cleaned)"""
SERIES_QUALITY_BODY = """SELECT * FROM (SELECT count(*) AS raw_weather_record_count,
                              count(*) FILTER (weather_timestamp IS NULL) AS invalid_weather_timestamp_count
                       FROM raw_times),
        (SELECT count(*) AS clean_hourly_weather_count, count(DISTINCT weather_station) AS weather_station_count,
                min(weather_date) AS weather_start_date, max(weather_date) AS weather_end_date FROM hourly)"""
DICTIONARY_SQL = f"""SELECT * FROM (VALUES {", ".join(str(row) for row in S.DICTIONARY)})
    AS d(source_field, target_field, spark_type, cleaning_rule, invalid_value_policy)"""


@query(
    "s12_data_dictionary",
    f"""WITH {PREPARED_SQL}, present AS (
          SELECT count(crime_id) AS crime_id, count(incident_timestamp) AS incident_timestamp,
                 count(district) AS district, count(community_area) AS community_area,
                 count(latitude) AS latitude, count(longitude) AS longitude, count(arrest) AS arrest,
                 count(domestic) AS domestic, count(primary_type) AS primary_type FROM prepared),
        counts AS (UNPIVOT present ON COLUMNS(*) INTO NAME target_field VALUE present_rows),
        dictionary(source_field, target_field, spark_type, cleaning_rule, invalid_value_policy) AS (
          VALUES {", ".join(str(row) for row in S.DICTIONARY)})
        SELECT dictionary.*, present_rows FROM dictionary JOIN counts USING (target_field)""",
)
def s12_data_dictionary(t: Tables):
    """The dictionary, with the rows of the prepared table that hold a value for each field."""
    dictionary = contracts.data_dictionary(t.spark, S.DICTIONARY)
    targets = [row[1] for row in S.DICTIONARY]
    prepared = t.prepared().withColumnRenamed("Primary Type", "primary_type")
    counts = prepared.agg(*[F.count(name).alias(name) for name in targets])
    counts = counts.unpivot([], targets, "target_field", "present_rows")
    return dictionary.join(counts, "target_field").select(*dictionary.columns, "present_rows")


@query(
    "p1_normalize_columns",
    """SELECT event_id AS "ID", event_type AS "Primary Type", value AS "Latitude", user_id FROM events""",
    floats=['"Latitude"'],
)
def p1_normalize_columns(t: Tables):
    raw = t.read("events").selectExpr("event_id AS ID", "event_type AS PRIMARY_TYPE", "value AS LATITUDE", "user_id")
    return contracts.normalize_columns(raw, S.INCIDENTS.aliases)


@query("p2_require_columns", "SELECT event_id, event_type, value FROM events", floats=["value"])
def p2_require_columns(t: Tables):
    required = ["event_id", "event_type", "value"]
    return contracts.require_columns(t.read("events"), required, "Events").select(*required)


@query(
    "p3_cast_columns",
    f"WITH {PREPARED_SQL} SELECT crime_id, district, community_area, latitude, longitude FROM prepared",
    floats=["latitude", "longitude"],
)
def p3_cast_columns(t: Tables):
    raw = contracts.normalize_columns(t.raw_incidents(), S.INCIDENTS.aliases)
    names = ["crime_id", "district", "community_area", "latitude", "longitude"]
    texts = raw.select("ID", *[F.col(S.INCIDENTS.casts[n][0]).alias(f"text_{n}") for n in names[1:]])
    casts = {n: (f"text_{n}" if n != "crime_id" else "ID", S.INCIDENTS.casts[n][1]) for n in names}
    return contracts.cast_columns(texts, casts).select(*names)


@query(
    "p4_parse_number",
    """SELECT event_id, CASE WHEN event_id % 11 = 0 OR event_id % 13 = 0 THEN NULL
              ELSE value::DECIMAL(18, 2)::DOUBLE END AS number FROM events""",
    floats=["number"],
)
def p4_parse_number(t: Tables):
    text = """CASE WHEN event_id % 11 = 0 THEN '  ' WHEN event_id % 13 = 0 THEN 'n/a'
              ELSE concat(' ', cast(value as decimal(18, 2)), ' ') END AS text"""
    return t.read("events").selectExpr("event_id", text).select(
        "event_id", parse_number(F.col("text")).alias("number")
    )


@query(
    "p5_parse_timestamp",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 53 = 0 THEN NULL WHEN o_orderkey % 4 = 3 THEN o_orderdate
              ELSE o_orderdate + to_hours((o_custkey % 24)::INTEGER) END AS parsed FROM orders""",
    times=["parsed"],
)
def p5_parse_timestamp(t: Tables):
    ts = "o_orderdate + make_dt_interval(0, cast(o_custkey % 24 as int))"
    text = f"""CASE WHEN o_orderkey % 53 = 0 THEN 'not-a-date'
                    WHEN o_orderkey % 4 = 0 THEN date_format({ts}, 'MM/dd/yyyy hh:mm:ss a')
                    WHEN o_orderkey % 4 = 1 THEN date_format({ts}, 'MM/dd/yyyy HH:mm:ss')
                    WHEN o_orderkey % 4 = 2 THEN date_format({ts}, 'yyyy-MM-dd HH:mm:ss')
                    ELSE date_format({ts}, 'yyyy-MM-dd') END AS text"""
    parsed = parse_timestamp(F.col("text"), S.INCIDENTS.timestamp_formats)
    return t.read("orders").selectExpr("o_orderkey", text).select("o_orderkey", parsed.alias("parsed"))


@query(
    "p6_parse_bool",
    """SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN true WHEN 1 THEN true WHEN 2 THEN true WHEN 3 THEN false
              WHEN 4 THEN false END AS flag FROM orders""",
)
def p6_parse_bool(t: Tables):
    text = """CASE o_orderkey % 6 WHEN 0 THEN ' T ' WHEN 1 THEN 'Yes' WHEN 2 THEN '1' WHEN 3 THEN 'FALSE'
              WHEN 4 THEN 'n' ELSE 'maybe' END AS text"""
    return t.read("orders").selectExpr("o_orderkey", text).select(
        "o_orderkey", parse_bool(F.col("text")).alias("flag")
    )


@query(
    "p7_calendar",
    f"WITH {EVENT_FACTS_SQL} SELECT crime_id, year, month, hour, day_of_week FROM facts",
)
def p7_calendar(t: Tables):
    return t.event_facts().select("crime_id", "year", "month", "hour", "day_of_week")


@query(
    "p8_project_contract",
    """SELECT event_id AS crime_id, event_type AS primary_type, NULL::VARCHAR AS block FROM events""",
)
def p8_project_contract(t: Tables):
    raw = t.read("events").selectExpr("event_id AS crime_id", "concat(' ', event_type, '  ') AS `Primary Type`")
    return contracts.project_contract(raw, ["crime_id", "primary_type", "block"], S.INCIDENTS.texts)


@query(
    "p9_map_codes",
    """SELECT event_id, CASE WHEN code IN (95, 96, 99) THEN 'thunderstorm'
              WHEN code IN (71, 73, 75, 77, 85, 86) THEN 'snow'
              WHEN code IN (51, 53, 55, 56, 57, 61, 63, 65, 66, 67, 80, 81, 82) THEN 'rain'
              WHEN code IN (45, 48) THEN 'fog_or_mist' WHEN code > 3 THEN 'other_reported_weather'
              ELSE 'no_reported_weather' END AS weather_event
       FROM (SELECT event_id, CASE WHEN event_id % 101 = 100 THEN NULL ELSE event_id % 101 - 1 END AS code
             FROM events)""",
)
def p9_map_codes(t: Tables):
    code = F.expr("CASE WHEN event_id % 101 = 100 THEN NULL ELSE event_id % 101 - 1 END")
    label = map_codes(code, S.WEATHER_CODES, S.QUIET, S.WEATHER.code_above)
    return t.read("events").select("event_id", label.alias("weather_event"))


PREPARED_COLUMNS = (
    "crime_id, incident_timestamp, year, month, hour, day_of_week, arrest, domestic, district, community_area,"
    " latitude, longitude, has_valid_crime_id, has_valid_timestamp, has_valid_coordinates, has_valid_district,"
    " has_valid_community_area"
)


@query(
    "p13_prepare",
    f"WITH {PREPARED_SQL} SELECT {PREPARED_COLUMNS} FROM prepared",
    floats=["latitude", "longitude"],
    times=["incident_timestamp"],
)
def p13_prepare(t: Tables):
    return t.prepared().select(*PREPARED_COLUMNS.split(", "))


@query(
    "p13_clean",
    f"WITH {PREPARED_SQL} SELECT * FROM cleaned",
    floats=["latitude", "longitude"],
    times=["incident_timestamp"],
)
def p13_clean(t: Tables):
    return cleaned(t, files.scratch_dir(t.spark))[1]


REASON_SQL = """concat_ws(',', CASE WHEN NOT has_valid_crime_id THEN 'invalid_crime_id' END,
                               CASE WHEN NOT has_valid_timestamp THEN 'invalid_timestamp' END)"""


@query(
    "p16_rejection_reason",
    f"""WITH {PREPARED_SQL} SELECT {REASON_SQL} AS rejection_reason, count(*) AS records
        FROM prepared WHERE NOT (has_valid_crime_id AND has_valid_timestamp) GROUP BY 1""",
)
def p16_rejection_reason(t: Tables):
    rejected = contracts.quarantine(t.prepared(), S.INCIDENT_REASONS)
    return rejected.groupBy("rejection_reason").agg(F.count("*").alias("records"))


@query("p17_prepare_lookup", f"WITH {LOOKUP_SQL} SELECT * FROM lookup", floats=S.AREA_MEASURES)
def p17_prepare_lookup(t: Tables):
    return t.lookup()


@query(
    "p18_prepare_series",
    f"WITH {OBSERVATIONS_SQL} SELECT * FROM observations",
    floats=["temperature_f", "precipitation_inches", "relative_humidity", "wind_speed_mph"],
    dates=["weather_date"],
    times=["weather_timestamp"],
)
def p18_prepare_series(t: Tables):
    return t.observations()


@query(
    "f1_flags",
    f"""WITH {FACTS_SQL} SELECT crime_id, has_valid_crime_id, has_valid_timestamp, has_valid_coordinates,
        has_valid_district, has_valid_community_area FROM facts""",
)
def f1_flags(t: Tables):
    return t.facts().select("crime_id", *[flag.name for flag in S.INCIDENTS.flags])


@query(
    "f2_reject",
    f"WITH {FACTS_SQL} SELECT crime_id, year, hour FROM facts WHERE crime_id > 0 AND incident_timestamp IS NOT NULL",
)
def f2_reject(t: Tables):
    return contracts.reject(t.facts(), S.INCIDENTS.mandatory).select("crime_id", "year", "hour")


@query(
    "f3_quarantine",
    f"""WITH {FACTS_SQL} SELECT crime_id, primary_type, {REASON_SQL} AS rejection_reason FROM facts
        WHERE NOT (crime_id > 0 AND incident_timestamp IS NOT NULL)""",
)
def f3_quarantine(t: Tables):
    rejected = contracts.quarantine(t.facts(), S.INCIDENT_REASONS)
    return rejected.select("crime_id", "primary_type", "rejection_reason")


@query("f4_keep_range", f"WITH {FACTS_SQL} SELECT crime_id, community_area FROM facts WHERE community_area BETWEEN 1 AND 77")
def f4_keep_range(t: Tables):
    kept = contracts.keep_range(t.facts(), "community_area", *S.AREAS.key_range)
    return kept.select("crime_id", "community_area")


@query(
    "f5_drop_null",
    f"""WITH {FACTS_SQL} SELECT crime_id, latitude, longitude, hour FROM facts
        WHERE latitude IS NOT NULL AND longitude IS NOT NULL AND hour IS NOT NULL""",
    floats=["latitude", "longitude"],
)
def f5_drop_null(t: Tables):
    return contracts.drop_null(t.facts(), S.CLUSTER_FEATURES).select("crime_id", *S.CLUSTER_FEATURES)


@query(
    "f7_require_flags",
    f"""WITH {FACTS_SQL} SELECT crime_id, arrest, primary_type FROM facts
        WHERE has_valid_coordinates AND has_valid_district AND has_valid_community_area
          AND arrest IS NOT NULL AND primary_type IS NOT NULL""",
)
def f7_require_flags(t: Tables):
    kept = contracts.require_flags(t.facts(), S.MODEL.flags, ["arrest", "primary_type"])
    return kept.select("crime_id", "arrest", "primary_type")


@query(
    "a1_source_quality",
    f"WITH {PREPARED_SQL} SELECT count(*) AS raw_record_count, {INVALID} FROM prepared",
)
def a1_source_quality(t: Tables):
    return quality.source_quality(t.prepared(), S.SOURCE_DEFECTS)


@query(
    "a2_quality_row",
    f"WITH {PREPARED_SQL} {QUALITY_BODY}",
)
def a2_quality_row(t: Tables):
    """Both rows read the prepared table as staged by the preparation job."""
    prepared, kept = cleaned(t, files.scratch_dir(t.spark))
    return quality.quality_row(prepared, kept, S.SOURCE_DEFECTS, S.CLEAN_DEFECTS, "crime_id")


@query(
    "a3_series_quality",
    f"WITH {HOURLY_WEATHER_SQL} {SERIES_QUALITY_BODY}",
    dates=["weather_start_date", "weather_end_date"],
)
def a3_series_quality(t: Tables):
    names = ("weather_station", "weather_date")
    return quality.series_quality(t.raw_weather(), jobs.weather_time(), t.hourly_weather(), names)


@query(
    "a4_dedup",
    """SELECT * EXCLUDE (n) FROM (
         SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate, l_partkey, l_suppkey,
                l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus) AS n FROM lineitem)
       WHERE n = 1""",
    floats=["l_quantity", "l_extendedprice", "l_discount", "l_tax"],
    times=["l_shipdate"],
)
def a4_dedup(t: Tables):
    folder = files.scratch_dir(t.spark)
    keys = ["l_orderkey", "l_linenumber"]
    return contracts.dedup(t.read("lineitem"), keys, ["l_shipdate"], keep=lambda df: files.stage(df, folder, "repeats"))


@query(
    "a29_count_rows",
    f"""WITH {LOOKUP_SQL} SELECT (SELECT 2 * count(*) + 1 FROM nation) AS raw_census_record_count,
        (SELECT count(*) FROM lookup) AS clean_community_area_count""",
)
def a29_count_rows(t: Tables):
    raw = quality.count_rows(t.raw_lookup(), "raw_census_record_count")
    return quality.with_scalar(raw, quality.count_rows(t.lookup(), "clean_community_area_count"))
