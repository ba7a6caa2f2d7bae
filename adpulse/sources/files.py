"""File sources: JSON lines and the Parquet archive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..schemas import Side, side_of

PARTITIONS = ("year", "month", "day", "hour")


def read_json_lines(
    spark: SparkSession, path: str, stream: bool = False, max_files_per_trigger: int | None = None
) -> DataFrame:
    """JSON lines as raw messages with one column ``value``, from a table or as a stream."""
    reader = spark.readStream if stream else spark.read
    if stream and max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.text(path)


def archive_schema(side: str | Side) -> T.StructType:
    """The stored columns and the four partition columns, the latter as zero-padded text."""
    partitions = [T.StructField(name, T.StringType()) for name in PARTITIONS]
    return T.StructType([*side_of(side).archive.fields, *partitions])


def read_archive(spark: SparkSession, path: str, side: str | Side, stream: bool = False) -> DataFrame:
    """The archive of a side. Filters on year, month, day and hour prune directories."""
    reader = spark.readStream if stream else spark.read
    return reader.schema(archive_schema(side)).parquet(path)
