"""Incident, weather and area tables derived from the given tables, each with its SQL twin.

The given tables hold no incidents. Every row of ``orders`` and ``events`` becomes one incident, with
text, defects, NULLs and duplicate ids made from its own columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import contracts, series
from ..operators.digest import SCALE, SHIFT
from ..plans import jobs, schemas as S

SERIES_YEARS = (1996, 1999)


class Tables:
    """The given tables of one folder, and the tables derived from them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def raw_incidents(self) -> DataFrame:
        """All-text incidents with upper-case headers from ``orders``."""
        ts = "o_orderdate + make_dt_interval(0, cast(o_custkey % 24 as int))"
        return self.read("orders").selectExpr(
            """CASE WHEN o_orderkey % 97 = 0 THEN 'bad' WHEN o_orderkey % 89 = 0 THEN NULL
                    WHEN o_orderkey % 83 = 0 THEN '-5' WHEN o_orderkey % 41 = 0 THEN string(o_orderkey + 1)
                    WHEN o_orderkey % 3 = 0 THEN concat(' ', o_orderkey, ' ')
                    WHEN o_orderkey % 5 = 0 THEN concat(o_orderkey, '.0')
                    ELSE string(o_orderkey) END AS ID""",
            f"""CASE WHEN o_orderkey % 53 = 0 THEN 'not-a-date'
                     WHEN o_orderkey % 4 = 0 THEN date_format({ts}, 'MM/dd/yyyy hh:mm:ss a')
                     WHEN o_orderkey % 4 = 1 THEN date_format({ts}, 'MM/dd/yyyy HH:mm:ss')
                     WHEN o_orderkey % 4 = 2 THEN date_format({ts}, 'yyyy-MM-dd HH:mm:ss')
                     ELSE date_format({ts}, 'yyyy-MM-dd') END AS DATE""",
            "concat(' ', o_orderpriority, ' ') AS PRIMARY_TYPE",
            "o_orderstatus AS BLOCK",
            "CASE WHEN o_custkey % 37 = 0 THEN '' ELSE string(o_custkey % 33) END AS DISTRICT",
            "concat(' ', o_custkey % 80) AS COMMUNITY_AREA_NUMBER",
            """CASE WHEN o_orderkey % 71 = 0 THEN 'abc' WHEN o_orderkey % 73 = 0 THEN '0.0'
                    ELSE string(cast(41.6 + (o_custkey % 500) / 1000 as decimal(9, 3))) END AS LATITUDE""",
            "string(cast(-87.9 + (o_orderkey % 400) / 1000 as decimal(9, 3))) AS LONGITUDE",
            """CASE o_orderstatus WHEN 'F' THEN ' TRUE ' WHEN 'O' THEN 'No'
                    ELSE CASE WHEN o_orderkey % 7 = 0 THEN 'maybe' ELSE 'f' END END AS ARREST""",
            "CASE WHEN o_orderkey % 2 = 0 THEN 'Y' ELSE '0' END AS DOMESTIC",
        )

    def prepared(self) -> DataFrame:
        return contracts.prepare(self.raw_incidents(), S.INCIDENTS)

    def facts(self) -> DataFrame:
        """Typed and flagged incidents of several years from ``orders``."""
        typed = self.read("orders").selectExpr(
            "o_orderkey AS crime_id",
            """CASE WHEN o_orderkey % 53 = 0 THEN NULL
                    ELSE o_orderdate + make_dt_interval(0, cast(o_custkey % 24 as int)) END
               AS incident_timestamp""",
            "CASE WHEN o_orderkey % 61 = 0 THEN NULL ELSE o_orderpriority END AS primary_type",
            "CASE WHEN o_orderkey % 67 = 0 THEN NULL ELSE o_orderstatus = 'F' END AS arrest",
            "CASE WHEN o_custkey % 37 = 0 THEN NULL ELSE int(o_custkey % 33) END AS district",
            "int(o_custkey % 27) AS community_area",
            """CASE WHEN o_orderkey % 71 = 0 THEN 0D WHEN o_orderkey % 89 = 0 THEN NULL
                    ELSE 41.6D + double(o_custkey % 500) / 1013D END AS latitude""",
            "-87.9D + double(o_orderkey % 400) / 1013D AS longitude",
        )
        return contracts.add_flags(
            contracts.add_calendar(typed, "incident_timestamp"), S.INCIDENTS.flags
        )

    def daily(self) -> DataFrame:
        """Daily counts of ``facts``, with weather flags hashed from the date."""
        timed = self.facts().filter("incident_timestamp IS NOT NULL")
        day = timed.groupBy(F.to_date("incident_timestamp").alias("weather_date"))
        counts = day.agg(F.count("*").alias("crime_count"))
        code = F.expr("conv(substring(md5(string(weather_date)), 1, 8), 16, 10) % 100").cast("int")
        bands = {
            "has_thunderstorm": (0, 8),
            "has_snow": (8, 20),
            "has_rain": (20, 40),
            "has_precipitation": (20, 45),
            "has_reported_weather_event": (0, 50),
        }
        flags = {name: code.between(low, high - 1).cast("int") for name, (low, high) in bands.items()}
        return counts.withColumns(flags)

    def series_days(self) -> DataFrame:
        """Days of a series that covers only some years of the incidents."""
        return self.daily().filter(F.year("weather_date").between(*SERIES_YEARS))

    def raw_lookup(self) -> DataFrame:
        """All-text area table from ``nation`` and the number of its customers, with a copy of each
        row and a total row."""
        customers = self.read("customer").groupBy(F.col("c_nationkey").alias("n_nationkey")).count()
        nation = self.read("nation").join(customers, "n_nationkey", "left").fillna(0, ["count"])
        rows = nation.selectExpr(
            "string(n_nationkey) AS k", "n_name AS n", "string(n_regionkey) AS r", "string(`count`) AS c"
        )
        copies = rows.selectExpr("concat(' ', k) AS k", "concat(n, '-COPY') AS n", "r", "c")
        total = nation.selectExpr(
            "string(NULL) AS k", "'TOTAL' AS n", "string(sum(n_regionkey)) AS r", "string(sum(`count`)) AS c"
        )
        measures = ["concat(r, '.5') AS PERCENT_OF_HOUSING_CROWDED"]
        measures += [f"r AS {name}" for name in S.AREA_MEASURES[1:-2]]
        measures += ["c AS PER_CAPITA_INCOME"]
        return rows.unionByName(copies).unionByName(total).selectExpr(
            "k AS `Community Area Number`",
            "concat(n, ' ') AS `COMMUNITY AREA NAME`",
            *measures,
            "CASE WHEN k = '7' THEN 'none' ELSE concat(r, k) END AS HARDSHIP_INDEX",
        )

    def lookup(self) -> DataFrame:
        return contracts.prepare_lookup(self.raw_lookup(), S.AREAS)

    def event_facts(self) -> DataFrame:
        """Every event as an incident; those of hour 5 have no usable time."""
        typed = self.read("events").selectExpr(
            "event_id AS crime_id",
            "event_type AS primary_type",
            "CASE WHEN hour(ts) = 5 THEN NULL ELSE ts END AS incident_timestamp",
        )
        return contracts.add_calendar(typed, "incident_timestamp")

    def raw_weather(self) -> DataFrame:
        """All-text observations, one per event; the code is hashed from the hour."""
        return (
            self.read("events")
            .withColumn(
                "h", F.expr("conv(substring(md5(date_format(ts, 'yyyy-MM-dd HH')), 1, 8), 16, 10) % 100")
            )
            .selectExpr(
                "concat(' S', user_id % 3, ' ') AS weather_location",
                """CASE WHEN event_id % 59 = 0 THEN 'bad'
                        WHEN event_id % 2 = 0 THEN date_format(ts, "yyyy-MM-dd'T'HH:mm")
                        ELSE date_format(ts, "yyyy-MM-dd'T'HH:mm:ss") END AS weather_timestamp""",
                """CASE WHEN event_id % 11 = 0 THEN ' ' WHEN event_id % 13 = 0 THEN 'n/a'
                        ELSE string(cast(value as decimal(18, 2))) END AS temperature_2m""",
                """CASE WHEN event_type = 'error' AND h NOT IN (2, 7) THEN '0.0'
                        WHEN event_type <> 'click' AND h IN (2, 7) THEN concat('0.', event_id % 7)
                   END AS precipitation""",
                "concat(' ', user_id % 100, ' ') AS relative_humidity_2m",
                "string(event_id % 30) AS wind_speed_10m",
                """CASE WHEN h = 0 THEN '95' WHEN h = 1 THEN '71.0' WHEN h = 2 THEN ' 61' WHEN h = 3 THEN '45'
                        WHEN h = 4 THEN '7' WHEN h = 5 THEN '-3' WHEN h = 6 THEN NULL ELSE '0' END
                   AS weather_code""",
            )
        )

    def observations(self) -> DataFrame:
        return series.prepare_series(self.raw_weather(), S.WEATHER)

    def hourly_weather(self) -> DataFrame:
        return jobs.hourly_weather(self.raw_weather())

    def daily_weather(self) -> DataFrame:
        return jobs.daily_weather(self.event_facts(), self.hourly_weather())

    def scored(self) -> DataFrame:
        """``lineitem`` with a fixed score, a label and the prediction at 0.5."""
        return self.read("lineitem").selectExpr(
            "l_orderkey",
            "CASE WHEN l_returnflag = 'R' THEN 1D ELSE 0D END AS label",
            "l_quantity / 50D AS score",
            "CASE WHEN l_quantity / 50D >= 0.5D THEN 1D ELSE 0D END AS prediction",
        )

    def model_table(self):
        from ..operators import models

        return models.model_table(self.facts(), S.MODEL)


# SQL twins. Each is a list of common table expressions without the leading WITH.

FLAGS_SQL = """
    coalesce(crime_id > 0, false) AS has_valid_crime_id,
    incident_timestamp IS NOT NULL AS has_valid_timestamp,
    coalesce(latitude BETWEEN 41.0 AND 43.0 AND longitude BETWEEN -88.5 AND -87.0, false)
        AS has_valid_coordinates,
    coalesce(district BETWEEN 1 AND 31, false) AS has_valid_district,
    coalesce(community_area BETWEEN 1 AND 77, false) AS has_valid_community_area
"""

CALENDAR_SQL = """
    CAST(year(incident_timestamp) AS INTEGER) AS year,
    CAST(month(incident_timestamp) AS INTEGER) AS month,
    CAST(hour(incident_timestamp) AS INTEGER) AS hour,
    CAST(dayofweek(incident_timestamp) + 1 AS INTEGER) AS day_of_week
"""

PREPARED_SQL = f"""
typed AS (
  SELECT CASE WHEN o_orderkey % 97 = 0 OR o_orderkey % 89 = 0 THEN NULL WHEN o_orderkey % 83 = 0 THEN -5
              WHEN o_orderkey % 41 = 0 THEN o_orderkey + 1 ELSE o_orderkey END AS crime_id,
         CASE WHEN o_orderkey % 53 = 0 THEN NULL WHEN o_orderkey % 4 = 3 THEN o_orderdate
              ELSE o_orderdate + to_hours((o_custkey % 24)::INTEGER) END AS incident_timestamp,
         o_orderpriority AS primary_type, o_orderstatus AS block,
         CASE WHEN o_custkey % 37 = 0 THEN NULL ELSE (o_custkey % 33)::INTEGER END AS district,
         (o_custkey % 80)::INTEGER AS community_area,
         CASE WHEN o_orderkey % 71 = 0 THEN NULL WHEN o_orderkey % 73 = 0 THEN 0
              ELSE (41600 + o_custkey % 500)::DOUBLE / 1000 END AS latitude,
         (o_orderkey % 400 - 87900)::DOUBLE / 1000 AS longitude,
         CASE o_orderstatus WHEN 'F' THEN true WHEN 'O' THEN false
              ELSE CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE false END END AS arrest,
         o_orderkey % 2 = 0 AS domestic
  FROM orders),
prepared AS (SELECT *, {CALENDAR_SQL}, {FLAGS_SQL} FROM typed),
kept AS (SELECT * FROM prepared WHERE has_valid_timestamp AND has_valid_crime_id),
cleaned AS (
  SELECT * EXCLUDE (n) FROM (
    SELECT crime_id, NULL::VARCHAR AS case_number, incident_timestamp, year, month, hour, day_of_week, block,
           primary_type, NULL::VARCHAR AS description, NULL::VARCHAR AS location_description, arrest, domestic,
           district, community_area, latitude, longitude, has_valid_crime_id, has_valid_coordinates,
           has_valid_district, has_valid_community_area,
           row_number() OVER (PARTITION BY crime_id ORDER BY incident_timestamp, block, primary_type,
               arrest NULLS FIRST, domestic, district NULLS FIRST, community_area, latitude NULLS FIRST) AS n
    FROM kept) WHERE n = 1)
"""

FACTS_SQL = f"""
typed AS (
  SELECT o_orderkey AS crime_id,
         CASE WHEN o_orderkey % 53 = 0 THEN NULL
              ELSE o_orderdate + to_hours((o_custkey % 24)::INTEGER) END AS incident_timestamp,
         CASE WHEN o_orderkey % 61 = 0 THEN NULL ELSE o_orderpriority END AS primary_type,
         CASE WHEN o_orderkey % 67 = 0 THEN NULL ELSE o_orderstatus = 'F' END AS arrest,
         CASE WHEN o_custkey % 37 = 0 THEN NULL ELSE (o_custkey % 33)::INTEGER END AS district,
         (o_custkey % 27)::INTEGER AS community_area,
         CASE WHEN o_orderkey % 71 = 0 THEN 0 WHEN o_orderkey % 89 = 0 THEN NULL
              ELSE 41.6::DOUBLE + (o_custkey % 500)::DOUBLE / 1013::DOUBLE END AS latitude,
         -87.9::DOUBLE + (o_orderkey % 400)::DOUBLE / 1013::DOUBLE AS longitude
  FROM orders),
facts AS (SELECT *, {CALENDAR_SQL}, {FLAGS_SQL} FROM typed)
"""

CONDITION_SQL = """CASE WHEN has_thunderstorm = 1 THEN 'thunderstorm' WHEN has_snow = 1 THEN 'snow'
    WHEN has_rain = 1 THEN 'rain' WHEN has_precipitation = 1 THEN 'other precipitation'
    WHEN has_reported_weather_event = 1 THEN 'other event' ELSE 'no event' END"""

DAILY_SQL = f"""{FACTS_SQL},
counted AS (
  SELECT incident_timestamp::DATE AS weather_date, count(*) AS crime_count,
         ('0x' || substr(md5(strftime(incident_timestamp::DATE, '%Y-%m-%d')), 1, 8))::BIGINT % 100 AS code
  FROM facts WHERE incident_timestamp IS NOT NULL GROUP BY incident_timestamp::DATE),
daily AS (
  SELECT weather_date, crime_count, (code < 8)::INTEGER AS has_thunderstorm,
         (code >= 8 AND code < 20)::INTEGER AS has_snow, (code >= 20 AND code < 40)::INTEGER AS has_rain,
         (code >= 20 AND code < 45)::INTEGER AS has_precipitation,
         (code < 50)::INTEGER AS has_reported_weather_event
  FROM counted)
"""

LOOKUP_SQL = """
lookup AS (
  SELECT n_nationkey AS community_area, n_name AS community_name,
         n_regionkey + 0.5::DOUBLE AS percent_housing_crowded,
         n_regionkey::DOUBLE AS percent_households_below_poverty,
         n_regionkey::DOUBLE AS percent_aged_16_unemployed,
         n_regionkey::DOUBLE AS percent_aged_25_without_high_school_diploma,
         n_regionkey::DOUBLE AS percent_aged_under_18_or_over_64,
         (SELECT count(*) FROM customer WHERE c_nationkey = n_nationkey)::DOUBLE AS per_capita_income,
         CASE WHEN n_nationkey = 7 THEN NULL
              ELSE (n_regionkey::VARCHAR || n_nationkey::VARCHAR)::DOUBLE END AS hardship_index
  FROM nation WHERE n_nationkey BETWEEN 1 AND 77)
"""

EVENT_FACTS_SQL = f"""
event_typed AS (
  SELECT event_id AS crime_id, event_type AS primary_type,
         CASE WHEN hour(ts) = 5 THEN NULL ELSE ts END AS incident_timestamp
  FROM events),
facts AS (SELECT *, {CALENDAR_SQL} FROM event_typed)
"""

OBSERVATIONS_SQL = """
hashed AS (
  SELECT *, ('0x' || substr(md5(strftime(ts, '%Y-%m-%d %H')), 1, 8))::BIGINT % 100 AS h FROM events),
raw_times AS (
  SELECT *, CASE WHEN event_id % 59 = 0 THEN NULL WHEN event_id % 2 = 0 THEN date_trunc('minute', ts)
                 ELSE date_trunc('second', ts) END AS weather_timestamp FROM hashed),
observations AS (
  SELECT 'S' || (user_id % 3)::VARCHAR AS weather_station, weather_timestamp::TIMESTAMP AS weather_timestamp,
         weather_timestamp::DATE AS weather_date, hour(weather_timestamp)::INTEGER AS weather_hour,
         CASE WHEN event_id % 11 = 0 OR event_id % 13 = 0 THEN NULL
              ELSE value::DECIMAL(18, 2)::DOUBLE END AS temperature_f,
         CASE WHEN event_type = 'error' AND h NOT IN (2, 7) THEN 0
              WHEN event_type <> 'click' AND h IN (2, 7) THEN (event_id % 7)::DOUBLE / 10 END AS precipitation_inches,
         (user_id % 100)::DOUBLE AS relative_humidity, (event_id % 30)::DOUBLE AS wind_speed_mph,
         CASE WHEN h = 0 THEN 'thunderstorm' WHEN h = 1 THEN 'snow' WHEN h = 2 THEN 'rain'
              WHEN h = 3 THEN 'fog_or_mist' WHEN h = 4 THEN 'other_reported_weather'
              ELSE 'no_reported_weather' END AS weather_event
  FROM raw_times WHERE weather_timestamp IS NOT NULL)
"""

HOURLY_WEATHER_SQL = f"""{OBSERVATIONS_SQL},
hourly AS (
  SELECT weather_date, weather_hour, min(weather_station) AS weather_station,
         avg(temperature_f) AS average_temperature_f, max(precipitation_inches) AS hourly_precipitation_inches,
         avg(relative_humidity) AS average_relative_humidity, avg(wind_speed_mph) AS average_wind_speed_mph,
         max((weather_event <> 'no_reported_weather')::INTEGER) AS has_reported_weather_event,
         max((weather_event = 'rain')::INTEGER) AS has_rain, max((weather_event = 'snow')::INTEGER) AS has_snow,
         max((weather_event = 'thunderstorm')::INTEGER) AS has_thunderstorm,
         coalesce(max(precipitation_inches) > 0, false)::INTEGER AS has_precipitation
  FROM observations GROUP BY weather_date, weather_hour)
"""

# Days from any ``facts`` and ``hourly``.
JOINED_DAYS_SQL = """
counts AS (
  SELECT incident_timestamp::DATE AS weather_date, hour(incident_timestamp)::INTEGER AS weather_hour,
         count(*) AS crime_count
  FROM facts WHERE incident_timestamp IS NOT NULL GROUP BY 1, 2),
joined AS (
  SELECT hourly.*, coalesce(crime_count, 0) AS crime_count
  FROM hourly LEFT JOIN counts USING (weather_date, weather_hour)),
daily AS (
  SELECT weather_date, sum(crime_count)::BIGINT AS crime_count,
         avg(average_temperature_f) AS average_temperature_f,
         avg(average_relative_humidity) AS average_relative_humidity,
         avg(average_wind_speed_mph) AS average_wind_speed_mph,
         sum(coalesce(hourly_precipitation_inches, 0)) AS reported_precipitation_inches,
         max(has_reported_weather_event) AS has_reported_weather_event,
         max(has_precipitation) AS has_precipitation, max(has_rain) AS has_rain, max(has_snow) AS has_snow,
         max(has_thunderstorm) AS has_thunderstorm
  FROM joined GROUP BY weather_date)
"""

DAILY_WEATHER_SQL = f"""{EVENT_FACTS_SQL}, {HOURLY_WEATHER_SQL}, {JOINED_DAYS_SQL}"""

# Conditions of any ``daily``.
CONDITIONS_SQL = f"""
impact AS (
  SELECT {CONDITION_SQL} AS weather_condition, count(*) AS day_count,
         avg(crime_count) AS average_daily_crime_count,
         quantile_disc(crime_count, 0.5) AS median_daily_crime_count
  FROM daily GROUP BY 1)
"""

IMPACT_SQL = f"""{DAILY_WEATHER_SQL}, {CONDITIONS_SQL}"""

SCORED_SQL = """
scored AS (
  SELECT l_orderkey, CASE WHEN l_returnflag = 'R' THEN 1.0::DOUBLE ELSE 0 END AS label,
         l_quantity / 50 AS score,
         CASE WHEN l_quantity / 50 >= 0.5 THEN 1.0::DOUBLE ELSE 0 END AS prediction
  FROM lineitem)
"""

MODEL_TABLE_SQL = f"""{FACTS_SQL},
model_rows AS (
  SELECT crime_id, primary_type, arrest::INTEGER::DOUBLE AS label, year, latitude, longitude, hour, month,
         district, community_area
  FROM facts
  WHERE has_valid_coordinates AND has_valid_district AND has_valid_community_area AND arrest IS NOT NULL
    AND primary_type IS NOT NULL AND hour IS NOT NULL)
"""


def key_hash_sql(key: str, seed: int = S.SAMPLE_SEED) -> str:
    """SQL twin of ``key_hash``."""
    return f"('0x' || substr(md5('{seed}:' || {key}::VARCHAR), 1, 8))::BIGINT"


def digest_sql(name: str, sql: str, columns: str = "*") -> str:
    """SQL twin of ``table_digest`` over a query."""
    text = f"""CASE WHEN typeof(COLUMNS(*)) = 'DOUBLE'
            THEN floor(TRY_CAST(COLUMNS(*)::VARCHAR AS DOUBLE) * {SCALE} + {SHIFT})::BIGINT::VARCHAR
            ELSE COLUMNS(*)::VARCHAR END"""
    return f"""SELECT '{name}' AS name, count(*) AS records,
            coalesce(sum(('0x' || substr(md5(concat_ws('|', *COLUMNS(*))), 1, 8))::BIGINT), 0)::BIGINT AS digest
        FROM (SELECT coalesce({text}, 'NULL') FROM (SELECT {columns} FROM ({sql})))"""
