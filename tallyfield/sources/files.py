"""Table readers and sinks. ``mode`` is ``overwrite`` or ``errorifexists``."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping, Sequence
from contextlib import contextmanager

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from ..operators.contracts import quarantine
from ..operators.sampling import bounded_sample
from ..operators.scalars import at_least

ONE_FILE_ROWS = 100_000


def read_raw_csv(spark: SparkSession, path: str) -> DataFrame:
    """Header CSV with every column as text, so that bad values are found by explicit casts."""
    return spark.read.option("header", True).option("mode", "PERMISSIVE").csv(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Parquet table; partition columns come from its directories."""
    return spark.read.parquet(path)


def write_table(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Named result table as Parquet."""
    df.write.mode(mode).parquet(path)


def write_partitioned(df: DataFrame, path: str, keys: Sequence[str], mode: str = "overwrite") -> None:
    """Parquet partitioned by ``keys``; NULL keys go to the default partition.

    Rebalancing brings rows of a partition together, so there are few files, and splits a partition
    that holds much of the data over several tasks.
    """
    df.hint("rebalance", *keys).write.mode(mode).partitionBy(*keys).parquet(path)


def write_quarantine(
    prepared: DataFrame, reasons: Mapping[str, str], path: str, mode: str = "overwrite"
) -> None:
    """Rejected rows with their reasons as Parquet."""
    write_table(quarantine(prepared, reasons), path, mode)


def export_csv(
    df: DataFrame, path: str, order_by: Sequence[str], mode: str = "overwrite", single_file: bool = True
) -> None:
    """Readable CSV with header in row order.

    One file is for tables a person opens: above ``ONE_FILE_ROWS`` rows it is refused. Without
    ``single_file`` the rows are sorted over many tasks, and the files are in order by name.
    """
    if single_file and at_least(df, ONE_FILE_ROWS + 1):
        raise ValueError(f"{path}: more than {ONE_FILE_ROWS} rows; pass single_file=False.")
    ordered = df.repartition(1).sortWithinPartitions(*order_by) if single_file else df.orderBy(*order_by)
    ordered.write.mode(mode).option("header", True).csv(path)


def export_stage(
    spark: SparkSession,
    tables: Mapping[str, Mapping[str, tuple[str, Sequence[str]]]],
    stages: Iterable[str],
    out_dir: str,
) -> list[str]:
    """Export the named tables of the selected stages; ``tables`` is {stage: {name: (path, order)}}."""
    written = []
    for stage in stages:
        for name, (path, order_by) in tables[stage].items():
            target = f"{out_dir}/{stage}_{name}"
            export_csv(read_table(spark, path), target, order_by)
            written.append(target)
    return written


def write_sample(df: DataFrame, path: str, fraction: float, cap: int, key: str, seed: int = 42) -> None:
    """Bounded key-hash sample as Parquet."""
    write_table(bounded_sample(df, key, fraction, cap, seed), path)


def save_model(model: PipelineModel, path: str) -> None:
    """Fitted model, replacing an earlier one."""
    model.write().overwrite().save(path)


def scratch_dir(spark: SparkSession) -> str:
    """A fresh folder for tables that later jobs read back; what is left of it goes when the application ends.

    It lies in the shared folder that ``spark.checkpoint.dir`` names, else in the warehouse folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    shared = shared or spark.conf.get("spark.sql.warehouse.dir")
    folder = f"{shared.rstrip('/')}/tallyfield-{uuid.uuid4().hex}"
    path, system = _located(spark, folder)
    system.mkdirs(path)
    system.deleteOnExit(path)
    return folder


def _located(spark: SparkSession, folder: str):
    """A path and its file system."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


@contextmanager
def scratch(spark: SparkSession):
    """A scratch folder that is removed at the end of the block, with the tables staged in it."""
    folder = scratch_dir(spark)
    try:
        yield folder
    finally:
        path, system = _located(spark, folder)
        system.delete(path, True)


def stage(df: DataFrame, folder: str, name: str) -> DataFrame:
    """Write a frame that several jobs need once, and read it back: lost executors cost no recomputation."""
    path = f"{folder}/{name}"
    write_table(df, path)
    return read_table(df.sparkSession, path)
