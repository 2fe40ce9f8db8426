"""One-row frames as scalar subqueries, and bounded counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

MAX_BROADCAST_ROWS = 10_000


def scalar_row(one_row: DataFrame) -> Column:
    """A one-row frame as a struct value; Spark runs it once, and more than one row is an error."""
    return one_row.select(F.struct(*[F.col(f"`{c}`") for c in one_row.columns])).scalar()


def with_scalar(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Add the columns of a one-row frame to every row, without a join; NULLs if it has no row."""
    value = scalar_row(one_row)
    return df.select("*", *[value.getField(c).alias(c) for c in one_row.columns])


def over_all(value: Column) -> Column:
    """An aggregate over a whole frame beside its rows.

    One task sees all rows, so this is only for frames that are small by construction: one row per
    cluster, per condition or per area of the lookup. It saves the second scan that a subquery costs.
    """
    return value.over(Window.partitionBy(F.lit(0)))


def grouped_total(grouped: DataFrame, value: str) -> Column:
    """Sum of a column of an aggregated frame, as a scalar.

    The subquery reads every column of the frame, although one would do: so its aggregate equals the
    frame's own, and Spark runs the scan and the exchange once for both.
    """
    others = [F.max(f"`{c}`").alias(c) for c in grouped.columns if c != value]
    return scalar_row(grouped.agg(F.sum(value).alias("_total"), *others)).getField("_total")


def at_least(df: DataFrame, n: int) -> bool:
    """Whether a frame has ``n`` rows or more; reading stops there."""
    return df.limit(n).count() >= n


def distinct_values(df: DataFrame, *cols: str) -> DataFrame:
    """The distinct values of some columns."""
    return df.select(*cols).distinct()
