"""File sinks."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import require_utc
from ..sources.files import PARTITIONS


def batch_files(path: str, file_format: str = "parquet") -> Callable[[DataFrame, int], None]:
    """Write every micro-batch to its own folder ``batch_id=N``.

    The folder is overwritten, so a batch that is repeated after a failure replaces its rows instead
    of doubling them. Metric rows and dead letters (with code and reason) can both go here.
    """

    def write(rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").format(file_format).save(f"{path}/batch_id={batch_id}")

    return write


def read_batches(spark: SparkSession, path: str, file_format: str = "parquet") -> DataFrame:
    """All rows written by :func:`batch_files`."""
    return spark.read.format(file_format).load(path).drop("batch_id")


def write_archive(
    rows: DataFrame, path: str, options: Mapping[str, str] | None = None, mode: str = "append"
) -> None:
    """Write a table of archive rows (see :func:`adpulse.operators.to_archive`) as Parquet by hour.

    The rows are rebalanced by hour first, so each hour is written by few tasks in files of a good
    size instead of by every task in crumbs. Adaptive execution also splits an hour that holds much
    more than the others, so a busy hour does not end in one task.
    """
    require_utc(rows.sparkSession)
    by_hour = rows.hint("rebalance", *PARTITIONS)
    by_hour.write.mode(mode).options(**(options or {})).partitionBy(*PARTITIONS).parquet(path)


def read_latest(spark: SparkSession, path: str, keys: list[str], file_format: str = "parquet") -> DataFrame:
    """Of the rows written by :func:`batch_files`, per ``keys`` the one of the last batch that has it."""
    rows = spark.read.format(file_format).load(path)
    last = F.max("batch_id").over(Window.partitionBy(*keys))
    return rows.withColumn("_last", last).where("batch_id = _last").drop("batch_id", "_last")
