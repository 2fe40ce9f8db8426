"""JSON documents of aligned arrays to rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, DataType, StringType, StructField, StructType


def read_payloads(
    spark: SparkSession,
    path: str,
    root: str,
    time_col: str,
    value_cols: Mapping[str, DataType],
    multi_line: bool = False,
) -> DataFrame:
    """One row per JSON document, with a stated schema, so that no pass infers one.

    A file holds one document per line, or with ``multi_line`` a single document.
    """
    fields = [StructField(time_col, ArrayType(StringType()))]
    fields += [StructField(name, ArrayType(kind)) for name, kind in value_cols.items()]
    schema = StructType([StructField(root, StructType(fields))])
    return spark.read.schema(schema).option("multiLine", multi_line).json(path)


def explode_aligned(
    df: DataFrame, root: str, time_col: str, value_cols: Sequence[str], constants: Mapping[str, str]
) -> DataFrame:
    """One row per array position, with constant columns in front.

    A document without the root, without times, or with a series that is absent or of another
    length fails the job.
    """
    times = F.col(f"{root}.{time_col}")
    length = F.size(times)

    def checked(name: str) -> Column:
        values = F.col(f"{root}.{name}")
        return F.when(F.size(values) == length, values).otherwise(
            F.raise_error(F.lit(f"The payload holds an incomplete {name} series."))
        )

    present = F.when(times.isNotNull() & (length > 0), times).otherwise(
        F.raise_error(F.lit(f"The payload holds no {root} {time_col} values."))
    )
    checked_df = df.select(present.alias(time_col), *[checked(name).alias(name) for name in value_cols])
    rows = checked_df.select(F.explode(F.arrays_zip(time_col, *value_cols)).alias("row"))
    return rows.select(*[F.lit(value).alias(name) for name, value in constants.items()], "row.*")
