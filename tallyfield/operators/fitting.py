"""Helpers for iterative fits: kept frames, even partitions, several fits at a time."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from contextlib import contextmanager
from multiprocessing.pool import ThreadPool
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.storagelevel import StorageLevel

PARALLEL_FITS = 8
FIT_PARTITIONS = 16
#: Rows to a partition where more than ``FIT_PARTITIONS`` are needed, and rows that fits submitted together may hold.
PARTITION_ROWS = 250_000
TOGETHER_ROWS = 24_000_000

Item = TypeVar("Item")
Result = TypeVar("Result")


@contextmanager
def persisted(df: DataFrame):
    """Keep a frame that several jobs read, and release it whatever happens."""
    held = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield held
    finally:
        held.unpersist()


def spread(df: DataFrame, key: str | Sequence[str], partitions: int = FIT_PARTITIONS) -> DataFrame:
    """Deal rows that many passes will read by the hash of their key, one column or several, in key order.

    A fit draws its start and its bootstrap per partition, so it depends on where rows lie. With a
    stated number of partitions it is the same on any cluster and however its input was split; a
    caller with more rows than 16 tasks can hold states a larger number.
    """
    keys = [key] if isinstance(key, str) else list(key)
    return df.repartition(partitions, *keys).sortWithinPartitions(*keys)


def fit_partitions(rows: int) -> int:
    """The number of partitions for so many rows: their tasks grow in number, not in size."""
    return max(FIT_PARTITIONS, -(-rows // PARTITION_ROWS))


def fits_together(rows: int) -> int:
    """How many fits on so many rows to submit together: each keeps its rows as objects, some 200 bytes a row of a forest."""
    return max(1, min(PARALLEL_FITS, TOGETHER_ROWS // max(rows, 1)))


def concurrently(
    spark: SparkSession, run: Callable[[Item], Result], items: Sequence[Item], parallelism: int = PARALLEL_FITS
) -> list[Result]:
    """Results in item order. The driver submits up to ``parallelism`` series of Spark jobs at a time,
    so that the tail of one does not leave executors idle."""
    with ThreadPool(max(1, min(parallelism, len(items)))) as pool:
        return pool.map(inheritable_thread_target(spark)(run), items, chunksize=1)
