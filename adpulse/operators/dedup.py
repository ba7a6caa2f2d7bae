"""Removal of repeated raw messages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import envelope, fingerprint


def with_fingerprint(messages: DataFrame, value: str = "value") -> DataFrame:
    """Add ``hash``, ``data`` (the message as it is) and ``version`` wrapped in ``envelope``."""
    return messages.withColumns({"hash": fingerprint(value), "envelope": envelope(value)})


def deduplicate(
    messages: DataFrame,
    value: str = "value",
    event_time: str | None = None,
    delay: str | None = None,
) -> DataFrame:
    """One row ``(hash, value)`` per distinct raw message.

    On a table this is a distinct over both columns: equal messages meet in the task that reads them
    before anything is shuffled, so a message repeated a billion times costs one row per task, and
    only numbers of a hash table are kept, no sort. On a stream the hash is remembered for ``delay``
    of event time, so ``event_time`` and ``delay`` are required there and all columns are kept.
    """
    hashed = messages.withColumn("hash", fingerprint(value))
    if not messages.isStreaming:
        return hashed.select("hash", F.col(value)).distinct()
    if event_time is None or delay is None:
        raise ValueError("on a stream give event_time and delay")
    return hashed.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(["hash"])
