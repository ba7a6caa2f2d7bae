"""Session settings the library relies on."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings that can be changed on a running session. Shuffle partitions are left to the cluster:
# with adaptive execution, set ``spark.sql.adaptive.coalescePartitions.initialPartitionNum`` so that
# the largest shuffle gives each partition a few hundred MB; Spark merges the small ones.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # state larger than memory, and only changes are uploaded at each commit
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

_ALLOW_MULTIPLE = "spark.sql.streaming.statefulOperator.allowMultiple"


def configure(spark: SparkSession) -> SparkSession:
    """Apply :data:`RUNTIME_CONF` to a session."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def require_utc(spark: SparkSession) -> None:
    """Fail unless the session zone is UTC: archive paths and printed instants are in UTC."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "Z", "GMT", "+00:00"):
        raise ValueError(f"spark.sql.session.timeZone must be UTC, not {zone}")


@contextmanager
def exact_late_boundary(spark: SparkSession) -> Iterator[None]:
    """Start queries inside this block to drop late rows exactly at the watermark.

    By default Spark accepts a row for one more micro-batch after its window closed, to support
    chained stateful operators. The jobs have a single one. A query keeps the value it started with.
    """
    before = spark.conf.get(_ALLOW_MULTIPLE, "true")
    spark.conf.set(_ALLOW_MULTIPLE, "false")
    try:
        yield
    finally:
        spark.conf.set(_ALLOW_MULTIPLE, before)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder path below ``spark.checkpoint.dir``, the folder all executors can reach.

    Only where the cluster names none, as in local tests, a temporary folder stands in for it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        base = tempfile.mkdtemp(prefix="adpulse-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
