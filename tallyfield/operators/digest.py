"""Digests of whole tables that do not depend on the order of their rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DataType, DoubleType, FloatType

#: Doubles are compared in steps of 1 / SCALE. The shift keeps values with few digits off the edges of the steps, so that
#: sums that differ in their last digit have one text.
SCALE, SHIFT = 100_000, 0.503


def value_text(col: Column, kind: DataType) -> Column:
    """The text of a value, 'NULL' for a missing one."""
    if isinstance(kind, (DoubleType, FloatType)):
        col = F.floor(col * SCALE + F.lit(SHIFT))
    return F.coalesce(col.cast("string"), F.lit("NULL"))


def table_digest(df: DataFrame, name: str) -> DataFrame:
    """``name``, ``records`` and ``digest`` in one row: the sum over rows of 32 bits of the MD5 of the row's text.

    Sums are made in every task, so no row is shuffled; an empty table has the digest 0.
    """
    row = F.concat_ws("|", *[value_text(F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields])
    part = F.conv(F.substring(F.md5(row), 1, 8), 16, 10).cast("long")
    return df.agg(F.count("*").alias("records"), F.coalesce(F.sum(part), F.lit(0).cast("long")).alias("digest")).select(
        F.lit(name).alias("name"), "records", "digest"
    )
