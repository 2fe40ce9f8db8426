"""Contracts of the three input tables. All values in this file are fixed values of the input formats."""

from __future__ import annotations

from ..operators.contracts import FactContract, Flag, LookupContract, dictionary_rows
from ..operators.models import ModelSpec
from ..operators.series import DailyRollup, HourlyRollup, SeriesContract

# Incident table.
INCIDENT_REASONS = {"invalid_crime_id": "has_valid_crime_id", "invalid_timestamp": "has_valid_timestamp"}

INCIDENTS = FactContract(
    name="Incident",
    aliases={
        "CASE_NUMBER": "Case Number",
        "DATE": "Date",
        "BLOCK": "Block",
        "PRIMARY_TYPE": "Primary Type",
        "DESCRIPTION": "Description",
        "LOCATION_DESCRIPTION": "Location Description",
        "COMMUNITY_AREA_NUMBER": "Community Area",
        "LATITUDE": "Latitude",
        "LONGITUDE": "Longitude",
        "ARREST": "Arrest",
        "DOMESTIC": "Domestic",
        "DISTRICT": "District",
    },
    required=(
        "ID",
        "Date",
        "District",
        "Community Area",
        "Latitude",
        "Longitude",
        "Arrest",
        "Domestic",
        "Primary Type",
    ),
    key="crime_id",
    timestamp="incident_timestamp",
    timestamp_source="Date",
    timestamp_formats=("MM/dd/yyyy hh:mm:ss a", "MM/dd/yyyy HH:mm:ss", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd"),
    casts={
        "crime_id": ("ID", "long"),
        "district": ("District", "int"),
        "community_area": ("Community Area", "int"),
        "latitude": ("Latitude", "double"),
        "longitude": ("Longitude", "double"),
        "arrest": ("Arrest", "boolean"),
        "domestic": ("Domestic", "boolean"),
    },
    texts={
        "case_number": "Case Number",
        "block": "Block",
        "primary_type": "Primary Type",
        "description": "Description",
        "location_description": "Location Description",
    },
    flags=(
        Flag("has_valid_crime_id", {"crime_id": (1, None)}),
        Flag("has_valid_timestamp", {"incident_timestamp": (None, None)}),
        Flag("has_valid_coordinates", {"latitude": (41.0, 43.0), "longitude": (-88.5, -87.0)}),
        Flag("has_valid_district", {"district": (1, 31)}),
        Flag("has_valid_community_area", {"community_area": (1, 77)}),
    ),
    reasons=INCIDENT_REASONS,
    columns=(
        "crime_id",
        "case_number",
        "incident_timestamp",
        "year",
        "month",
        "hour",
        "day_of_week",
        "block",
        "primary_type",
        "description",
        "location_description",
        "arrest",
        "domestic",
        "district",
        "community_area",
        "latitude",
        "longitude",
        "has_valid_crime_id",
        "has_valid_coordinates",
        "has_valid_district",
        "has_valid_community_area",
    ),
)

# Defect counts of the quality row and the flags behind them.
SOURCE_DEFECTS = {
    "crime_id": "has_valid_crime_id",
    "timestamp": "has_valid_timestamp",
    "coordinate": "has_valid_coordinates",
    "district": "has_valid_district",
    "community_area": "has_valid_community_area",
}
CLEAN_DEFECTS = {what: flag for what, flag in SOURCE_DEFECTS.items() if what != "timestamp"}

DICTIONARY = dictionary_rows(INCIDENTS)

# Area lookup.
AREA_MEASURES = (
    "percent_housing_crowded",
    "percent_households_below_poverty",
    "percent_aged_16_unemployed",
    "percent_aged_25_without_high_school_diploma",
    "percent_aged_under_18_or_over_64",
    "per_capita_income",
    "hardship_index",
)

AREAS = LookupContract(
    name="Area lookup",
    key="community_area",
    key_range=(1, 77),
    text="community_name",
    measures=AREA_MEASURES,
    aliases={
        "Community Area Number": "community_area",
        "COMMUNITY_AREA_NUMBER": "community_area",
        "COMMUNITY AREA NAME": "community_name",
        "COMMUNITY_AREA_NAME": "community_name",
        "PERCENT OF HOUSING CROWDED": "percent_housing_crowded",
        "PERCENT_OF_HOUSING_CROWDED": "percent_housing_crowded",
        "PERCENT HOUSEHOLDS BELOW POVERTY": "percent_households_below_poverty",
        "PERCENT_HOUSEHOLDS_BELOW_POVERTY": "percent_households_below_poverty",
        "PERCENT AGED 16+ UNEMPLOYED": "percent_aged_16_unemployed",
        "PERCENT_AGED_16__UNEMPLOYED": "percent_aged_16_unemployed",
        "PERCENT AGED 25+ WITHOUT HIGH SCHOOL DIPLOMA": "percent_aged_25_without_high_school_diploma",
        "PERCENT_AGED_25__WITHOUT_HIGH_SCHOOL_DIPLOMA": "percent_aged_25_without_high_school_diploma",
        "PERCENT AGED UNDER 18 OR OVER 64": "percent_aged_under_18_or_over_64",
        "PERCENT_AGED_UNDER_18_OR_OVER_64": "percent_aged_under_18_or_over_64",
        "PER CAPITA INCOME ": "per_capita_income",
        "PER_CAPITA_INCOME": "per_capita_income",
        "HARDSHIP INDEX": "hardship_index",
        "HARDSHIP_INDEX": "hardship_index",
    },
)

# Hourly weather observations and their codes.
WEATHER_CODES = {
    "thunderstorm": (95, 96, 99),
    "snow": (71, 73, 75, 77, 85, 86),
    "rain": (51, 53, 55, 56, 57, 61, 63, 65, 66, 67, 80, 81, 82),
    "fog_or_mist": (45, 48),
}
QUIET = "no_reported_weather"

WEATHER = SeriesContract(
    name="Weather",
    required=(
        "weather_location",
        "weather_timestamp",
        "temperature_2m",
        "precipitation",
        "relative_humidity_2m",
        "wind_speed_10m",
        "weather_code",
    ),
    timestamp="weather_timestamp",
    timestamp_formats=("yyyy-MM-dd'T'HH:mm", "yyyy-MM-dd'T'HH:mm:ss"),
    station=("weather_location", "weather_station"),
    day="weather_date",
    hour="weather_hour",
    measures={
        "temperature_f": "temperature_2m",
        "precipitation_inches": "precipitation",
        "relative_humidity": "relative_humidity_2m",
        "wind_speed_mph": "wind_speed_10m",
    },
    code="weather_code",
    category="weather_event",
    code_groups=WEATHER_CODES,
    code_default=QUIET,
    code_above=(3, "other_reported_weather"),
)

HOURLY_WEATHER = HourlyRollup(
    keys=("weather_date", "weather_hour"),
    station="weather_station",
    means={
        "average_temperature_f": "temperature_f",
        "average_relative_humidity": "relative_humidity",
        "average_wind_speed_mph": "wind_speed_mph",
    },
    maxima={"hourly_precipitation_inches": "precipitation_inches"},
    category="weather_event",
    quiet_category=QUIET,
    any_event="has_reported_weather_event",
    category_flags={"has_rain": "rain", "has_snow": "snow", "has_thunderstorm": "thunderstorm"},
    positive_flags={"has_precipitation": "hourly_precipitation_inches"},
)
HOURLY_COLUMNS = (
    "weather_date",
    "weather_hour",
    "weather_station",
    "average_temperature_f",
    "hourly_precipitation_inches",
    "average_relative_humidity",
    "average_wind_speed_mph",
    "has_reported_weather_event",
    "has_rain",
    "has_snow",
    "has_thunderstorm",
    "has_precipitation",
)

DAILY_WEATHER = DailyRollup(
    day="weather_date",
    count="crime_count",
    means=("average_temperature_f", "average_relative_humidity", "average_wind_speed_mph"),
    sums={"reported_precipitation_inches": "hourly_precipitation_inches"},
    flags=("has_reported_weather_event", "has_precipitation", "has_rain", "has_snow", "has_thunderstorm"),
)

# Condition of a day, by falling priority.
CONDITIONS = {
    "has_thunderstorm": "thunderstorm",
    "has_snow": "snow",
    "has_rain": "rain",
    "has_precipitation": "other precipitation",
    "has_reported_weather_event": "other event",
}
NO_EVENT = "no event"

CORRELATIONS = {
    "temperature_crime_correlation": "average_temperature_f",
    "precipitation_crime_correlation": "reported_precipitation_inches",
    "humidity_crime_correlation": "average_relative_humidity",
    "wind_crime_correlation": "average_wind_speed_mph",
}

# Analysis settings.
CENSUS_YEARS = (2008, 2012)
ROLLING_DAYS = 7
CLUSTER_FEATURES = ("latitude", "longitude", "hour")
SMALLEST_SAMPLE = 100
SAMPLE_SEED = 42
OUTPUT_FRACTION = 0.02
OUTPUT_CAP = 50_000
MAP_FRACTION = 0.1
MAP_CAP = 20_000
TRAIN_FRACTION = 0.8

MODEL = ModelSpec(
    key="crime_id",
    category="primary_type",
    target="arrest",
    year="year",
    numbers=("latitude", "longitude", "hour", "month", "district", "community_area"),
    flags=("has_valid_coordinates", "has_valid_district", "has_valid_community_area"),
)

# Payload of the weather service.
PAYLOAD_ROOT = "hourly"
PAYLOAD_TIME = "time"
PAYLOAD_SERIES = (
    "temperature_2m",
    "precipitation",
    "relative_humidity_2m",
    "wind_speed_10m",
    "weather_code",
)
