"""What the operators of this folder share: id remainders, words, staged tables, row maps over Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ..sources.files import scratch, scratch_dir, stage

__all__ = ["WordHashes", "documents", "id_remainder", "keep", "map_rows", "ngram_hashes", "remember_only", "scratch", "slices", "stage"]

#: Entries that a task remembers of a vocabulary before it starts anew: bounds memory, changes no result.
MEMO = 1 << 19
#: The same where a worker goes from operator to operator, as in a pipeline.
SMALL_MEMO = 1 << 17
#: Rows of an Arrow batch that are Python objects at a time.
SLICE = 256


def documents(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    """A table of the given folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_remainder(key: Column, modulus: int) -> Column:
    """``crc32`` of a key's text modulo ``modulus``; a null key counts as empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit(""))) % modulus


def slices(source: Iterator) -> Iterator:
    """Parts of at most ``SLICE`` rows of Arrow batches or arrays: long texts are not all copied at once."""
    for batch in source:
        for at in range(0, len(batch), SLICE):
            yield batch.slice(at, SLICE)


def map_rows(df: DataFrame, schema: str, fn: Callable[[Iterator[tuple]], Iterable[tuple]], rows: int = 4096) -> DataFrame:
    """Apply ``fn`` to the rows of each partition as tuples, in Arrow batches of at most ``rows`` results."""
    fields = StructType.fromDDL(schema)
    names = fields.fieldNames()

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        target = to_arrow_schema(fields)
        given = (row for part in slices(source) for row in zip(*[column.to_pylist() for column in part.columns]))
        held: list[tuple] = []
        for row in fn(given):
            held.append(row)
            if len(held) >= rows:
                yield _batch(held, target)
                held = []
        if held:
            yield _batch(held, target)
        pa.default_memory_pool().release_unused()

    def _batch(held, target):
        return pa.RecordBatch.from_arrays(
            [pa.array(values, type=field.type) for values, field in zip(zip(*held), target)], names=names
        )

    return df.mapInArrow(batches, fields)


def keep(df: DataFrame) -> DataFrame:
    """Write a finished result to the shared folder and read it back, so that scratch tables behind it can go."""
    return stage(df, scratch_dir(df.sparkSession), "result")


#: The memo that this Python worker filled last.
_LAST: list = []


def remember_only(memo) -> None:
    """Empty the memo of another operator before this one grows.

    Spark hands Python workers on from stage to stage, so memos of several operators would add up in one process.
    """
    if not _LAST or _LAST[0] is not memo:
        for other in _LAST:
            other.clear()
        _LAST[:] = [memo]


class WordHashes(dict):
    """64-bit hashes of words (bytes), remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= SMALL_MEMO:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, text: str | None) -> np.ndarray:
        """Hashes of the white-space separated words of a text, A-Z in lower case."""
        words = (text or "").encode("utf-8", "surrogatepass").lower().split()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


_MIX = np.uint64(0x9E3779B97F4A7C15)
_MIX_2 = np.uint64(0xBF58476D1CE4E5B9)


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection that spreads 64-bit values."""
    values = (values ^ (values >> np.uint64(30))) * _MIX_2
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def ngram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` word hashes; fewer words are one run, no word none."""
    if len(words) == 0:
        return words
    n = min(n, len(words))
    size = len(words) - n + 1
    out = np.full(size, np.uint64(n), np.uint64)
    for i in range(n):
        out = mixed(out * _MIX + words[i : i + size])
    return out
