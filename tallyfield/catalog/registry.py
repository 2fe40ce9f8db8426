"""Registration of queries and of the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import wraps

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DateType, DoubleType, TimestampNTZType, TimestampType

from ..operators.ordering import number_rows
from ..sources import files
from .standins import Tables

# Sums of doubles depend on their order in the last digit. Both engines add this before they round, so
# that a value halfway between two roundings (an average of cents over 32 days, say) falls on one side.
TIE_SHIFT = 3e-8

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def comparable(df: DataFrame) -> DataFrame:
    """Doubles to 6 digits and times as text, so that two engines agree on every value."""

    def shown(name, kind):
        col = F.col(f"`{name}`")
        if isinstance(kind, DoubleType):
            return F.round(col + F.lit(TIE_SHIFT), 6).alias(name)
        if isinstance(kind, DateType):
            return col.cast("string").alias(name)
        if isinstance(kind, (TimestampType, TimestampNTZType)):
            return F.date_format(col, "yyyy-MM-dd HH:mm:ss").alias(name)
        return col

    return df.select(*[shown(f.name, f.dataType) for f in df.schema.fields])


def query(
    name: str,
    sql: str | None = None,
    floats: Sequence[str] = (),
    dates: Sequence[str] = (),
    times: Sequence[str] = (),
    longs: Sequence[str] = (),
    ints: Sequence[str] = (),
    order: str | None = None,
):
    """Register a function of ``Tables``; the column lists shape the SQL output like ``comparable``.

    ``order`` is the SQL order of a query whose rows are ordered. Its result has the ``position`` of each row as it lies,
    and SQL numbers its rows, so that a table in another order is another result.
    """
    shapes = [f"round({c} + {TIE_SHIFT}::DOUBLE, 6) AS {c}" for c in floats]
    shapes += [f"CAST({c} AS VARCHAR) AS {c}" for c in dates]
    shapes += [f"strftime({c}, '%Y-%m-%d %H:%M:%S') AS {c}" for c in times]
    shapes += [f"CAST({c} AS BIGINT) AS {c}" for c in longs]
    shapes += [f"CAST({c} AS INTEGER) AS {c}" for c in ints]

    def register(fn: Callable[[Tables], DataFrame]):
        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            found = fn(Tables(spark, sf_dir))
            if order is not None:
                folder = files.scratch_dir(spark)
                found = number_rows(found, "position", lambda rows: files.stage(rows, folder, "ordered"))
            return comparable(found)

        QUERIES[name] = run
        if sql is not None:
            numbered = f"SELECT *, row_number() OVER (ORDER BY {order}) AS position FROM ({sql})" if order else sql
            ORACLES[name] = f"SELECT * REPLACE ({', '.join(shapes)}) FROM ({numbered})" if shapes else numbered
        return fn

    return register
