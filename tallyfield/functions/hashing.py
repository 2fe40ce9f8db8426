"""Key hashing that does not depend on partitioning, row order or the engine."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

HASH_RANGE = 1 << 32


def key_hash(key: Column, seed: int) -> Column:
    """Uniform integer in ``[0, 2**32)`` from a key and a seed (first 8 hex digits of an MD5)."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def hash_bound(fraction: float) -> int:
    """Hash values below this bound make up ``fraction`` of the range."""
    if not 0.0 <= fraction <= 1.0:
        raise ValueError(f"A fraction lies between 0 and 1, not {fraction}.")
    return round(fraction * HASH_RANGE)
