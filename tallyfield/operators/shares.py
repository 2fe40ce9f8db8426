"""Counts with shares, rankings and running sums."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window, functions as F

from .scalars import grouped_total

MAX_RANGES = 1_000


def share_of(df: DataFrame, part: str, value: str, name: str, digits: int | None = None) -> DataFrame:
    """Share of each row in its partition's total; the input is already one row per counted group."""
    share = F.col(value) / F.sum(value).over(Window.partitionBy(part))
    return df.withColumn(name, share if digits is None else F.round(share, digits))


def distribution(df: DataFrame, col: str, name: str) -> DataFrame:
    """Count per value and its share of all rows, to 4 digits; the total is summed from the counts."""
    counts = df.groupBy(col).count()
    return counts.withColumn(name, F.round(F.col("count") / grouped_total(counts, "count"), 4))


def alignment(df: DataFrame, by: str, group: str, count: str, keep_null: bool) -> DataFrame:
    """Rows per (by, group) and their share of ``by``, to 4 digits."""
    kept = df if keep_null else df.filter(F.col(group).isNotNull())
    counts = kept.groupBy(by, group).agg(F.count("*").alias(count))
    return share_of(counts, by, count, f"{by}_share", 4)


def dominant_share(df: DataFrame, by: str, group: str, name: str) -> DataFrame:
    """Mean over ``by`` of the largest group share; NULL groups are left out, 0.0 when nothing is left."""
    counts = df.filter(F.col(group).isNotNull()).groupBy(by, group).count()
    per_part = counts.groupBy(by).agg((F.max("count") / F.sum("count")).alias("_share"))
    return per_part.agg(F.coalesce(F.avg("_share"), F.lit(0.0)).alias(name))


def top_n(df: DataFrame, value: str, tie: str, n: int) -> DataFrame:
    """The ``n`` rows with the largest value, ties by name."""
    return df.orderBy(F.desc(value), F.asc(tie)).limit(n)


def _ranged(steps: DataFrame, order: str, ranges: int) -> DataFrame:
    """Add ``_range``: the quantile range of a numeric column, rising with it; -1 for NULL.

    The quantiles are computed before the plan is built, so that every part of it sees the same ranges.
    """
    marks = [i / ranges for i in range(1, ranges)]
    value = F.col(order).cast("double")
    cuts = steps.agg(F.percentile_approx(value, marks).alias("cuts")).first()["cuts"] if marks else None
    inner = sorted({cut for cut in cuts or () if math.isfinite(cut)})
    if not inner:
        return steps.withColumn("_range", F.lit(0))
    bucketizer = Bucketizer(
        splits=[-math.inf, *inner, math.inf], inputCol="_value", outputCol="_bucket", handleInvalid="keep"
    )
    numbered = bucketizer.transform(steps.withColumn("_value", value))
    # Never NULL, or the join on it would filter one of its two inputs, and they would not be shared.
    number = F.coalesce(F.when(F.col(order).isNotNull(), F.col("_bucket").cast("int")), F.lit(-1))
    return numbered.withColumn("_range", number).drop("_value", "_bucket")


def _ranged_by(steps: DataFrame, order: str, ranges: int, by: str) -> DataFrame:
    """Add ``_range`` as above, from the quantiles of each group; the cuts of all groups are at most ``MAX_RANGES``."""
    value = F.col(order).cast("double")
    groups = max(1, steps.select(by).distinct().count())
    ranges = max(1, min(ranges, MAX_RANGES // groups))
    if ranges == 1:
        return steps.withColumn("_range", F.when(F.col(order).isNull(), -1).otherwise(0))
    marks = [i / ranges for i in range(1, ranges)]
    found = steps.groupBy(by).agg(F.percentile_approx(value, marks).alias("cuts")).collect()
    rows = [(r[by], sorted({c for c in r["cuts"] or () if math.isfinite(c)})) for r in found]
    kind = steps.schema[by].dataType.simpleString()
    cuts = steps.sparkSession.createDataFrame(rows, f"_by {kind}, _cuts array<double>")
    placed = steps.join(F.broadcast(cuts), F.col(by).eqNullSafe(F.col("_by")), "left")
    number = F.size(F.filter("_cuts", lambda cut: cut <= value))
    return placed.withColumn("_range", F.when(F.col(order).isNull(), -1).otherwise(number)).drop("_by", "_cuts")


def prefix_sum(
    df: DataFrame, order: str, cols: Sequence[str], ranges: int | None = None, by: str | None = None
) -> DataFrame:
    """Sums per distinct value of a numeric column, their running sums in descending order, and the totals.

    One window over all rows would be one task. Here the distinct values are cut into ranges at
    approximate quantiles, each range has its own window, and the totals of the ranges above it (at
    most ``MAX_RANGES`` rows) are added. NULL comes last. Adds ``running_<col>`` and ``total_<col>``. With ``by`` all of
    this holds in each group of that column, which is meant for few groups, and one shuffle serves them all.
    """
    keys = [] if by is None else [by]
    return running_sums(df.groupBy(*keys, order).agg(*[F.sum(c).alias(c) for c in cols]), order, cols, ranges, by)


def running_sums(
    steps: DataFrame, order: str, cols: Sequence[str], ranges: int | None = None, by: str | None = None
) -> DataFrame:
    """``prefix_sum`` of rows that are summed already, one for each value (and group). They are read several times."""
    keys = [] if by is None else [by]
    if ranges is None:
        ranges = int(steps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = max(1, min(ranges, MAX_RANGES))
    ranged = _ranged(steps, order, ranges) if by is None else _ranged_by(steps, order, ranges, by)

    totals = ranged.groupBy(*keys, "_range").agg(*[F.sum(c).alias(f"_sum_{c}") for c in cols])
    every = Window.partitionBy(*(keys or [F.lit(0)]))
    higher = every.orderBy(F.desc("_range")).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *[F.col(k).alias("_group") for k in keys],
        F.col("_range").alias("_of"),
        *[F.coalesce(F.sum(f"_sum_{c}").over(higher), F.lit(0)).alias(f"_before_{c}") for c in cols],
        *[F.sum(f"_sum_{c}").over(every).alias(f"total_{c}") for c in cols],
    )
    inside = (
        Window.partitionBy(*keys, "_range")
        .orderBy(F.desc_nulls_last(order))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    running = ranged.select("*", *[F.sum(c).over(inside).alias(f"_inside_{c}") for c in cols])
    same = F.col("_range") == F.col("_of")
    for key in keys:
        same = same & F.col(key).eqNullSafe(F.col("_group"))
    return running.join(F.broadcast(offsets), same).select(
        *keys,
        order,
        *cols,
        *[(F.col(f"_inside_{c}") + F.col(f"_before_{c}")).alias(f"running_{c}") for c in cols],
        *[f"total_{c}" for c in cols],
    )
