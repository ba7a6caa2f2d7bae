"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from adpulse.session import shared_folder

PART = 1 << 20  # bytes of rows handed to a function at a time where much is made of each row

_RECORDS: list[list[str]] = []


def small_batches(spark: SparkSession) -> None:
    """From now on Spark hands batches of about :data:`PART` bytes to Python.

    By default a batch has 10,000 rows or 64 MB, and each running task holds one of texts more than once: in Spark's own
    buffers, outside the heap, and in its worker.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", PART)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a new folder below ``spark.checkpoint.dir`` and read it back.

    This cuts the lineage on storage that all executors share, so a lost executor costs no recomputation
    of what lies before. Inside :func:`recorded` the folder is noted, for :func:`delete_folders`.
    """
    spark = df.sparkSession
    path = shared_folder(spark, f"llm-{name}")
    if _RECORDS:
        _RECORDS[-1].append(path)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def recorded(folders: list[str]) -> Iterator[None]:
    """Note the folders that :func:`materialize` makes inside the block in ``folders``."""
    _RECORDS.append(folders)
    try:
        yield
    finally:
        _RECORDS.pop()


def delete_folders(spark: SparkSession, folders: list[str]) -> None:
    """Delete folders of :func:`materialize`, once nothing reads them any more, and empty the list."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    while folders:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folders.pop())
        path.getFileSystem(conf).delete(path, True)


def per_key(df: DataFrame, keys: list[str], *aggregates) -> DataFrame:
    """One row per key, for a join on the keys in which adaptive execution can split a key with very many rows.

    It only splits sides that are shuffled for the join itself. Grouped by a further column that follows from the
    keys, this side is; grouped by the keys alone, the join would take it as the aggregation left it.
    """
    half = F.pmod(F.xxhash64(*keys), F.lit(2)).alias("half")
    return df.groupBy(*keys, half).agg(*aggregates).drop("half")


def texts(docs: DataFrame, *more: str) -> DataFrame:
    """``doc_id``, the text as UTF-8 bytes (null: empty) and ``more``; other columns are left behind."""
    return docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"), *more)


def map_batches(df: DataFrame, function: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str, size: int = 0) -> DataFrame:
    """Apply ``function`` to each Arrow batch; it may return None for no rows.

    With ``size`` it is applied to slices of about so many bytes, one after the other, so that neither the worker
    nor Spark holds more than a slice's results at once.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            step = max(1, batch.num_rows * size // max(1, batch.nbytes) if size else batch.num_rows)
            for at in range(0, batch.num_rows, step):
                if (out := function(batch.slice(at, step))) is not None:
                    yield out

    return df.mapInArrow(run, schema)


def words_of(text: bytes) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` with A-Z in lower case; both ``bytes`` methods know ASCII only."""
    return text.lower().split()


def shingle_hashes(words: list[bytes], size: int, seed: int = 42) -> np.ndarray:
    """XXH64 of each run of ``size`` words joined by a space, repeats included.

    Fewer words: the whole sequence is the one shingle. No word: no shingle.
    """
    digest = xxhash.xxh64_intdigest
    if not words:
        return np.empty(0, np.uint64)
    if len(words) <= size:
        return np.array([digest(b" ".join(words), seed)], np.uint64)
    runs = zip(*(words[i:] for i in range(size)))
    return np.fromiter((digest(b" ".join(r), seed) for r in runs), np.uint64, len(words) - size + 1)


def most_frequent(table: DataFrame, key: str, most: int) -> pd.DataFrame:
    """At most ``most`` rows of ``table(key, n, ...)`` with the largest ``n``, in that order, on the driver.

    A small histogram over steps of about 1 % of ``n`` gives the step from which on rows fit, so no task sorts
    or sends more than its share of them.
    """
    step = F.floor(F.log2(F.col("n").cast("double")) * 64)
    left = most
    lowest = None
    for r in sorted(table.groupBy(step.alias("step")).count().collect(), key=lambda r: -r.step):
        left -= r["count"]
        if left < 0:
            break
        lowest = r.step
    if lowest is None:
        return table.where("false").toPandas()
    return table.where(step >= lowest).toPandas().sort_values(["n", key], ascending=[False, True], ignore_index=True)


def doc_crc(column: str = "doc_id"):
    """CRC-32 of the id as text; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")))


def row_hash(*columns: str):
    """A hash of these columns of a row; null differs from any value, equal rows have equal hashes."""
    return F.xxhash64(*(F.col(c) for c in columns), *(F.col(c).isNull() for c in columns))
