"""Hourly and daily series, calendars, rolling means and joins on them."""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.labels import map_codes
from ..functions.parsing import parse_int, parse_number, parse_timestamp
from .contracts import normalize_columns, require_columns


@dataclass(frozen=True)
class SeriesContract:
    """How raw text observations become a typed series with a category per observation."""

    name: str
    required: Collection[str]
    timestamp: str
    timestamp_formats: Sequence[str]
    station: tuple[str, str]
    day: str
    hour: str
    measures: Mapping[str, str]
    code: str
    category: str
    code_groups: Mapping[str, Sequence[int]]
    code_default: str
    code_above: tuple[int, str] | None = None
    aliases: Mapping[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class HourlyRollup:
    """Columns of an hourly rollup; mappings go from output to input column (or category)."""

    keys: tuple[str, str]
    station: str
    means: Mapping[str, str]
    maxima: Mapping[str, str]
    category: str
    quiet_category: str
    any_event: str
    category_flags: Mapping[str, str]
    positive_flags: Mapping[str, str]


@dataclass(frozen=True)
class DailyRollup:
    """Columns of a daily rollup over joined hours."""

    day: str
    count: str
    means: Sequence[str]
    sums: Mapping[str, str]
    flags: Sequence[str]


def prepare_series(raw: DataFrame, contract: SeriesContract) -> DataFrame:
    """Typed observations with day, hour and category; rows without a parseable time are rejected."""
    raw = require_columns(normalize_columns(raw, contract.aliases), contract.required, contract.name)
    station_source, station = contract.station
    category = map_codes(
        F.col("_code"), contract.code_groups, contract.code_default, contract.code_above
    )
    typed = raw.select(
        F.trim(F.col(station_source)).alias(station),
        parse_timestamp(F.col(contract.timestamp), contract.timestamp_formats).alias(contract.timestamp),
        *[parse_number(F.col(source)).alias(target) for target, source in contract.measures.items()],
        parse_int(F.col(contract.code)).alias("_code"),
    )
    ts = F.col(contract.timestamp)
    return typed.filter(ts.isNotNull()).select(
        station,
        ts,
        F.to_date(ts).alias(contract.day),
        F.hour(ts).alias(contract.hour),
        *contract.measures,
        category.alias(contract.category),
    )


def hourly_counts(df: DataFrame, ts: str, day: str, hour: str, count: str) -> DataFrame:
    """Rows per (day, hour) with a timestamp."""
    return (
        df.filter(F.col(ts).isNotNull())
        .groupBy(F.to_date(ts).alias(day), F.hour(ts).alias(hour))
        .agg(F.count("*").alias(count))
    )


def _any(condition: Column) -> Column:
    return F.max(F.when(condition, 1).otherwise(0))


def hourly_rollup(df: DataFrame, spec: HourlyRollup) -> DataFrame:
    """One row per (day, hour): smallest station, means, maxima and 0/1 flags per category.

    Observations are summed by hour and station first. So no buffer over them holds a string, which would make Spark
    sort them, and names are compared once per station of an hour.
    """
    category = F.col(spec.category)
    flags = {spec.any_event: category != spec.quiet_category}
    flags |= {flag: category == value for flag, value in spec.category_flags.items()}
    parts = df.groupBy(*spec.keys, spec.station).agg(
        *[F.sum(source).alias(f"_sum_{target}") for target, source in spec.means.items()],
        *[F.count(source).alias(f"_n_{target}") for target, source in spec.means.items()],
        *[F.max(source).alias(target) for target, source in spec.maxima.items()],
        *[_any(condition).alias(flag) for flag, condition in flags.items()],
    )
    rolled = parts.groupBy(*spec.keys).agg(
        F.array_min(F.collect_set(spec.station)).alias(spec.station),
        *[F.try_divide(F.sum(f"_sum_{name}"), F.sum(f"_n_{name}")).alias(name) for name in spec.means],
        *[F.max(name).alias(name) for name in [*spec.maxima, *flags]],
    )
    positive = {
        flag: F.coalesce(F.col(source) > 0, F.lit(False)).cast("int")
        for flag, source in spec.positive_flags.items()
    }
    return rolled.withColumns(positive)


def join_hourly(obs: DataFrame, counts: DataFrame, keys: Sequence[str], count: str) -> DataFrame:
    """Keep every observed hour; hours without incidents count 0."""
    return obs.join(counts, list(keys), "left").fillna({count: 0})


def daily_rollup(joined: DataFrame, spec: DailyRollup) -> DataFrame:
    """One row per day: summed counts, means of hourly means, summed measures, maximum of flags."""
    return joined.groupBy(spec.day).agg(
        F.sum(spec.count).cast("long").alias(spec.count),
        *[F.avg(name).alias(name) for name in spec.means],
        *[F.sum(F.coalesce(F.col(src), F.lit(0.0))).alias(dst) for dst, src in spec.sums.items()],
        *[F.max(flag).cast("int").alias(flag) for flag in spec.flags],
    )


def period(df: DataFrame, day: str) -> DataFrame:
    """First and last date of a series in one row."""
    return df.agg(F.min(day).alias("period_start"), F.max(day).alias("period_end"))


def within_period(df: DataFrame, ts: str, period_row: DataFrame, year: str | None = None) -> DataFrame:
    """Rows whose date lies in the period, both ends included.

    The bounds are scalar subqueries, so no join and no driver action is needed. ``year`` names a
    column with the year of ``ts``; a table partitioned by it is then read for these years only.
    """
    kind = df.schema[ts].dataType
    start = period_row.select(F.col("period_start").cast(kind)).scalar()
    end = period_row.select(F.date_add("period_end", 1).cast(kind)).scalar()
    if year is not None:
        first = period_row.select(F.year("period_start")).scalar()
        last = period_row.select(F.year("period_end")).scalar()
        df = df.filter((F.col(year) >= first) & (F.col(year) <= last))
    return df.filter((F.col(ts) >= start) & (F.col(ts) < end))


def spine(keys: DataFrame, key: str, days: DataFrame, day: str) -> DataFrame:
    """Every key with every observed day.

    Each key row unfolds the calendar between the first and the last day; an equi-join then keeps the
    days that were observed. So no cross join is planned.
    """
    bounds = period(days, day)
    start = bounds.select("period_start").scalar()
    end = bounds.select("period_end").scalar()
    calendar = keys.select(key, F.explode(F.sequence(start, end, F.expr("interval 1 day"))).alias(day))
    return calendar.join(days.select(day).distinct(), day, "left_semi").select(key, day)


def densify(counts: DataFrame, spine_df: DataFrame, keys: Sequence[str], count: str) -> DataFrame:
    """Counts on a dense spine; missing combinations are 0."""
    return spine_df.join(counts, list(keys), "left").fillna({count: 0})


def enrich(df: DataFrame, lookup: DataFrame, key: str) -> DataFrame:
    """Inner equi-join to a lookup; rows without a match go.

    No hint: Spark broadcasts the lookup if its bytes allow, at planning or once it has been computed.
    """
    return df.join(lookup, key, "inner")


def rolling_mean(df: DataFrame, part: str, order: str, value: str, n: int, name: str) -> DataFrame:
    """Mean of the last ``n`` rows per partition; the first rows use those there are."""
    frame = Window.partitionBy(part).orderBy(order).rowsBetween(1 - n, 0)
    return df.withColumn(name, F.avg(value).over(frame))


def numbered_days(days: DataFrame, day: str) -> DataFrame:
    """The observed days with their place from 0; one task numbers them, a row for each day of the calendar."""
    place = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(day)) - 1
    return days.select(day).filter(F.col(day).isNotNull()).distinct().withColumn("_place", place)


def rolling_sums(counts: DataFrame, numbered: DataFrame, key: str, day: str, count: str, n: int) -> DataFrame:
    """``key``, ``_place``, ``count`` and ``_sum`` of the last ``n`` observed days, where that is not 0.

    Each count is put on the days whose window holds it, and these are summed: the work grows with the counts, whatever
    the number of keys and days.
    """
    placed = counts.join(numbered, day).select(key, F.col(count).alias("_value"), F.col("_place").alias("_at"))
    last = F.col("_at") + (n - 1)
    spread = placed.select("*", F.explode(F.sequence("_at", last)).alias("_place"))
    own = F.when(F.col("_at") == F.col("_place"), F.col("_value")).otherwise(F.lit(0))
    return spread.groupBy(key, "_place").agg(F.sum(own).alias(count), F.sum("_value").alias("_sum"))


def rolling_dense(
    counts: DataFrame, keys: DataFrame, days: DataFrame, key: str, day: str, count: str, n: int, name: str
) -> DataFrame:
    """Every key with every observed day: its count and the mean of the last ``n`` days; the first days use those there are.

    The sums come from the counts alone; the dense table is only what they are written to.
    """
    numbered = numbered_days(days, day)
    sums = rolling_sums(counts, numbered, key, day, count, n)
    dense = spine(keys, key, days, day).join(numbered, day).join(sums, [key, "_place"], "left")
    dense = dense.fillna(0, [count, "_sum"])
    mean = F.col("_sum") / F.least(F.col("_place") + 1, F.lit(n))
    return dense.select(key, day, count, mean.alias(name))
