"""Total orders of result tables, and row numbers in them."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def ordered(df: DataFrame, *by: str | Column) -> DataFrame:
    """Rows by the stated columns; equal rows by the others, so that the order does not depend on partitioning."""
    stated = {c for c in by if isinstance(c, str)}
    sortable = [f.name for f in df.schema.fields if f.name not in stated and f.dataType.typeName() != "map"]
    return df.orderBy(*by, *[F.col(f"`{c}`") for c in sortable])


def number_rows(df: DataFrame, name: str, keep: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Add the place of each row, from 1, in the order in which rows lie.

    ``keep`` writes rows with their place in their partition and reads them back, so that no later pass sorts anew. The
    rows of each partition are counted, and the counts before it are added: at most a row per partition is summed in
    one task and sent to the others.
    """
    placed = keep(df.withColumn("_place", F.monotonically_increasing_id()))
    part = F.shiftright("_place", 33)
    counts = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_rows"))
    before = Window.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    numbered = placed.join(F.broadcast(offsets), part == F.col("_part"))
    nth = F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    return numbered.select(*[F.col(f"`{c}`") for c in df.columns], (F.col("_before") + nth + 1).alias(name))
