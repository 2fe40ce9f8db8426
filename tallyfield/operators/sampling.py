"""Samples and splits by key hash: the same rows whatever the partitioning."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.hashing import hash_bound, key_hash
from .scalars import at_least

SLICES = 1 << 16


def hash_sample(df: DataFrame, key: str, fraction: float, seed: int) -> DataFrame:
    """Rows whose key hash falls into the given fraction of the range."""
    return df.filter(key_hash(F.col(key), seed) < hash_bound(fraction))


def training_sample(df: DataFrame, key: str, fraction: float, floor: int, seed: int) -> DataFrame:
    """A key-hash sample; fewer than ``floor`` rows are an error, never a reason to use others."""
    sample = hash_sample(df, key, fraction, seed)
    if not at_least(sample, floor):
        raise ValueError(f"A sample of fraction={fraction} has fewer rows than floor={floor}.")
    return sample


def bounded_sample(df: DataFrame, key: str, fraction: float, cap: int, seed: int) -> DataFrame:
    """A key-hash sample of at most ``cap`` rows: those with the smallest hashes, then keys.

    A plain top-k would send up to ``cap`` rows of every task to one task. So the sample is first
    counted in 65,536 hash slices, and only slices up to the one that reaches the cap are sorted.
    """
    bound = hash_bound(fraction)
    value = key_hash(F.col(key), seed)
    hashed = df.withColumn("_hash", value).filter(F.col("_hash") < bound)
    slice_of = F.floor(F.col("_hash") * SLICES / F.lit(max(bound, 1)))
    counts = hashed.groupBy(slice_of.alias("_slice")).agg(F.count("*").alias("_rows"))
    before = Window.partitionBy(F.lit(0)).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    needed = counts.select("_slice", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    last = needed.filter(F.col("_before") < cap).agg(F.max("_slice")).scalar()
    rest = [c for c in df.columns if c != key]
    return hashed.filter(slice_of <= last).orderBy("_hash", key, *rest).limit(cap).drop("_hash")


def hash_split(df: DataFrame, key: str, train_fraction: float, seed: int) -> tuple[DataFrame, DataFrame]:
    """Disjoint training and test rows by key hash."""
    value, bound = key_hash(F.col(key), seed), hash_bound(train_fraction)
    return df.filter(value < bound), df.filter(value >= bound)


def temporal_split(df: DataFrame, year: str, back: int) -> tuple[DataFrame, DataFrame, int]:
    """Rows before and from the cutoff year, which is ``back`` years before the last; and the cutoff."""
    last = df.agg(F.max(year)).first()[0]
    if last is None:
        raise ValueError("A temporal split requires at least one row with a year.")
    cutoff = int(last) - back
    return df.filter(F.col(year) < cutoff), df.filter(F.col(year) >= cutoff), cutoff
