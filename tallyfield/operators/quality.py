"""Quality rows: totals and defect counts, one scan per frame."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from .scalars import with_scalar


def _defects(flags: Mapping[str, str], prefix: str) -> list[Column]:
    return [F.count_if(~F.col(flag)).alias(f"{prefix}_invalid_{what}_count") for what, flag in flags.items()]


def source_quality(prepared: DataFrame, flags: Mapping[str, str]) -> DataFrame:
    """Total and failed rows per flag before rejection; ``flags`` is {what: flag}. Counts are 0 on empty input."""
    return prepared.agg(F.count("*").alias("raw_record_count"), *_defects(flags, "raw"))


def clean_quality(cleaned: DataFrame, flags: Mapping[str, str], key: str) -> DataFrame:
    """Total, failed rows per flag and exact distinct keys after cleaning."""
    return cleaned.agg(
        F.count("*").alias("clean_record_count"),
        *_defects(flags, "clean"),
        F.countDistinct(key).alias(f"distinct_{key}_count"),
    )


def quality_row(
    prepared: DataFrame,
    cleaned: DataFrame,
    raw_flags: Mapping[str, str],
    clean_flags: Mapping[str, str],
    key: str,
) -> DataFrame:
    """Source and clean metrics in one row."""
    return with_scalar(source_quality(prepared, raw_flags), clean_quality(cleaned, clean_flags, key))


def series_quality(raw: DataFrame, parsed_ts: Column, hourly: DataFrame, names: Sequence[str]) -> DataFrame:
    """Raw rows, unparseable times, clean hours, stations and date range of a measurement series.

    ``names`` are the station and the date column of ``hourly``.
    """
    station, day = names
    raw_row = raw.agg(
        F.count("*").alias("raw_weather_record_count"),
        F.count_if(parsed_ts.isNull()).alias("invalid_weather_timestamp_count"),
    )
    hourly_row = hourly.agg(
        F.count("*").alias("clean_hourly_weather_count"),
        F.countDistinct(station).alias("weather_station_count"),
        F.min(day).alias("weather_start_date"),
        F.max(day).alias("weather_end_date"),
    )
    return with_scalar(raw_row, hourly_row)


def count_rows(df: DataFrame, name: str) -> DataFrame:
    """Row count as a one-row frame."""
    return df.agg(F.count("*").alias(name))
