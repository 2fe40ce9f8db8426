"""Summary tables by condition, season, time of day and area."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.labels import day_type, season
from .contracts import require_flags
from .scalars import grouped_total, over_all
from .series import enrich, rolling_dense, within_period

#: A deviation below this part of the largest value is rounding: sums of the same numbers differ so with their order.
ROUNDING = 1e-12


def condition_impact(daily: DataFrame, label: Column, count: str, name: str) -> DataFrame:
    """Days, mean and approximate median of the daily count per condition."""
    return daily.groupBy(label.alias(name)).agg(
        F.count("*").alias("day_count"),
        F.avg(count).alias(f"average_daily_{count}"),
        F.percentile_approx(count, 0.5).alias(f"median_daily_{count}"),
    )


def seasonal_impact(daily: DataFrame, label: Column, day: str, count: str, name: str) -> DataFrame:
    """Days, mean and sample deviation of the daily count per season and condition."""
    return daily.groupBy(season(F.col(day)).alias("season"), label.alias(name)).agg(
        F.count("*").alias("day_count"),
        F.avg(count).alias(f"average_daily_{count}"),
        F.stddev_samp(count).alias(f"{count}_standard_deviation"),
    )


def effect_sizes(impact: DataFrame, name: str, baseline: str, mean: str) -> DataFrame:
    """Absolute and percent difference of each condition's mean from the baseline condition.

    Percent is NULL when the baseline mean is 0; without a baseline row there is no result row.
    """
    tag = baseline.replace(" ", "_")
    base = f"{tag}_{mean}"
    absolute = f"absolute_difference_from_{tag}"
    share = F.try_divide(F.col(absolute), F.col(base)) * 100
    return (
        impact.withColumn(base, over_all(F.max(F.when(F.col(name) == baseline, F.col(mean)))))
        .filter(F.col(base).isNotNull())
        .withColumn(absolute, F.col(mean) - F.col(base))
        .withColumn(f"percent_difference_from_{tag}", share)
    )


def temporal_patterns(df: DataFrame, ts: str, count: str) -> DataFrame:
    """Counts per year, month, day of week and hour, as SQL text over the frame itself."""
    return df.sparkSession.sql(
        f"SELECT year, month, day_of_week, hour, count(*) AS {count} FROM {{facts}}"
        f" WHERE {ts} IS NOT NULL GROUP BY year, month, day_of_week, hour",
        facts=df,
    )


def weekday_weekend(df: DataFrame, ts: str, count: str) -> DataFrame:
    """Counts per day type and hour."""
    return (
        df.filter(F.col(ts).isNotNull())
        .groupBy(day_type(F.col("day_of_week")).alias("day_type"), "hour")
        .agg(F.count("*").alias(count))
    )


def weekday_totals(patterns: DataFrame, count: str) -> DataFrame:
    """The same table from the temporal table, without reading the facts again."""
    return patterns.groupBy(day_type(F.col("day_of_week")).alias("day_type"), "hour").agg(
        F.sum(count).alias(count)
    )


def hour_totals(patterns: DataFrame, count: str) -> DataFrame:
    """Total per hour of day from the temporal table."""
    return patterns.groupBy("hour").agg(F.sum(count).alias(count))


def correlations(df: DataFrame, target: str, names: Mapping[str, str]) -> DataFrame:
    """Pearson correlation of the target with each column, from ``{output: column}``.

    A column that is constant, or is so but for rounding, gives NULL; the built-in ``corr`` divides by zero there under
    ANSI mode.
    """

    def deviation(col: Column) -> Column:
        found = F.stddev_pop(col)
        return F.when(found > ROUNDING * F.max(F.abs(col)), found)

    def pearson(name: str) -> Column:
        x, y = F.col(target), F.col(name)
        spread = deviation(F.when(y.isNotNull(), x)) * deviation(F.when(x.isNotNull(), y))
        return F.try_divide(F.covar_pop(x, y), spread)

    return df.agg(*[pearson(column).alias(output) for output, column in names.items()])


def area_rolling(
    df: DataFrame,
    lookup: DataFrame,
    days: DataFrame,
    key: str,
    flag: str,
    ts: str,
    day: str,
    count: str,
    attributes: Sequence[str],
    n: int,
) -> DataFrame:
    """Rolling mean of the daily count per area over a dense calendar, with lookup attributes.

    Sums grow with the counts; only the result is dense.
    """
    counts = (
        require_flags(df, [flag]).groupBy(key, F.to_date(ts).alias(day)).agg(F.count("*").alias(count))
    )
    name = f"rolling_{n}_day_{count.removesuffix('_count')}_average"
    rolled = rolling_dense(counts, lookup, days, key, day, count, n, name)
    return enrich(rolled, lookup.select(key, *attributes), key).select(day, key, *attributes, count, name)


def area_summary(
    df: DataFrame,
    lookup: DataFrame,
    period_row: DataFrame,
    key: str,
    flag: str,
    ts: str,
    years: tuple[int, int],
    rate_of: str,
    attributes: Sequence[str],
    count: str,
) -> DataFrame:
    """Count and mean of a boolean per area inside the period and the year range.

    The facts are aggregated to one row per area before they meet the lookup.
    """
    kept = require_flags(df, [flag]).filter(F.col("year").between(*years))
    per_area = (
        within_period(kept, ts, period_row, "year")
        .groupBy(key)
        .agg(F.count("*").alias(count), F.avg(F.col(rate_of).cast("double")).alias(f"{rate_of}_rate"))
    )
    return enrich(per_area, lookup.select(key, *attributes), key).select(
        key, *attributes, count, f"{rate_of}_rate"
    )


def spatial_profile(
    df: DataFrame,
    lookup: DataFrame,
    period_row: DataFrame,
    key: str,
    flags: Sequence[str],
    ts: str,
    attributes: tuple[str, str],
    count: str,
) -> DataFrame:
    """Count, share of all located incidents, centroid and attributes per area in the period.

    The share counts areas without a lookup row too. Its total is summed from the per-area counts in
    parts, so no task sees all areas.
    """
    per_area = (
        within_period(require_flags(df, flags), ts, period_row, "year")
        .groupBy(key)
        .agg(
            F.count("*").alias(count),
            F.avg("latitude").alias("centroid_latitude"),
            F.avg("longitude").alias("centroid_longitude"),
        )
    )
    share = count.replace("count", "share")
    name, score = attributes
    shared = per_area.withColumn(share, F.col(count) / grouped_total(per_area, count))
    return enrich(shared, lookup.select(key, name, score), key).select(
        key, name, count, share, "centroid_latitude", "centroid_longitude", score
    )
