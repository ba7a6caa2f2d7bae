"""Streaming queries, one sink each."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import datetime
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from ..operators import (
    deduplicate, finish, observe_rejects, rejected, session_updates, to_archive, valid_events, validate, window_state, with_mapping,
)
from ..operators.metrics import window_updates
from ..schemas import Side, side_of
from ..session import exact_late_boundary, require_utc
from ..sources.files import PARTITIONS

Sink = Callable[[DataFrame, int], None]
AsOf = Column | datetime | str | None


def _start(writer: DataStreamWriter, name: str, checkpoint: str, trigger: Mapping[str, Any]) -> StreamingQuery:
    return writer.queryName(name).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def metrics_query(
    events: DataFrame,
    side: str | Side,
    sink: Sink,
    checkpoint: str,
    name: str = "metrics",
    size_ms: int = 60_000,
    slide_ms: int | None = None,
    delay_ms: int = 60_000,
    grain: str = "action",
    unique: str = "exact",
    labels: str = "reference",
    output_mode: str = "append",
    as_of: AsOf = None,
    trigger: Mapping[str, Any] | None = None,
) -> StreamingQuery:
    """Validate a stream of events and publish window metrics.

    The watermark is set after validation: a rejected event with a far-future timestamp must not
    make good events late. ``delay_ms`` is out-of-orderness plus allowed lateness. Spark's watermark
    follows the latest event of all partitions, so an idle partition never holds it back.

    ``append`` gives one row per window and key when the window is final. ``update`` also gives early
    and corrected rows at every batch; it needs ``unique="approx"``, since an exact count would have
    to keep a whole user set in one state row.
    """
    side = side_of(side)
    require_utc(events.sparkSession)
    good = valid_events(events, side, as_of).withWatermark("timestamp", f"{delay_ms} milliseconds")
    if output_mode == "update":
        rows = window_updates(good, side, size_ms, slide_ms, grain, unique, labels)
        publish = sink
    elif output_mode == "append":
        rows = window_state(good, side, size_ms, slide_ms, grain, unique)

        def publish(batch: DataFrame, batch_id: int) -> None:
            sink(finish(batch, side, size_ms, slide_ms, grain, unique, labels), batch_id)
    else:
        raise ValueError(f"output_mode must be append or update, not {output_mode!r}")
    writer = rows.writeStream.outputMode(output_mode).foreachBatch(publish)
    with exact_late_boundary(events.sparkSession):
        return _start(writer, name, checkpoint, trigger or {"processingTime": "60 seconds"})


def dead_letter_query(
    events: DataFrame,
    side: str | Side,
    sink: Sink,
    checkpoint: str,
    name: str = "dead_letters",
    as_of: AsOf = None,
    trigger: Mapping[str, Any] | None = None,
) -> StreamingQuery:
    """Route rejected events, with code and reason, to a sink and report the reject rate per batch."""
    letters = rejected(observe_rejects(validate(events, side, as_of), name))
    writer = letters.writeStream.outputMode("append").foreachBatch(sink)
    return _start(writer, name, checkpoint, trigger or {"processingTime": "60 seconds"})


def archive_query(
    events: DataFrame,
    side: str | Side,
    path: str,
    checkpoint: str,
    name: str = "archive",
    partition_by: str = "event",
    processing_time: Column | None = None,
    options: Mapping[str, str] | None = None,
    trigger: Mapping[str, Any] | None = None,
    writers_per_hour: int = 4,
) -> StreamingQuery:
    """Append a stream of events to the hourly Parquet archive, each batch exactly once.

    No state and no watermark; files become visible when their batch is committed. A batch is dealt by hour
    and a salt first, so an hour gets at most ``writers_per_hour`` files per batch, however many tasks read
    the topic, and a busy hour still has several writers.
    """
    require_utc(events.sparkSession)
    rows = to_archive(events, side, processing_time, partition_by)
    salt = F.pmod(F.xxhash64("event_id"), F.lit(writers_per_hour))
    rows = rows.repartition(*PARTITIONS, salt)
    writer = (
        rows.writeStream.outputMode("append").format("parquet")
        .options(**(options or {})).option("path", path).partitionBy(*PARTITIONS)
    )
    return _start(writer, name, checkpoint, trigger or {"processingTime": "60 seconds"})


def session_query(
    events: DataFrame,
    side: str | Side,
    sink: Sink,
    checkpoint: str,
    name: str = "sessions",
    gap_ms: int = 1_800_000,
    delay_ms: int = 60_000,
    grain: str = "action",
    as_of: AsOf = None,
    trigger: Mapping[str, Any] | None = None,
) -> StreamingQuery:
    """Validate a stream of events and publish a row per session when nothing can join it any more."""
    require_utc(events.sparkSession)
    good = valid_events(events, side, as_of).withWatermark("timestamp", f"{delay_ms} milliseconds")
    writer = session_updates(good, side, gap_ms, grain).writeStream.outputMode("append").foreachBatch(sink)
    with exact_late_boundary(events.sparkSession):
        return _start(writer, name, checkpoint, trigger or {"processingTime": "60 seconds"})


def mapping_query(
    events: DataFrame,
    mappings: Callable[[SparkSession], DataFrame],
    sink: Sink,
    checkpoint: str,
    name: str = "mapping",
    trigger: Mapping[str, Any] | None = None,
) -> StreamingQuery:
    """Add to each event of a stream its mapping, from a table that ``mappings`` reads anew for every batch.

    A static frame joined to the stream would keep the list of files it had when the query started.
    """

    def publish(batch: DataFrame, batch_id: int) -> None:
        sink(with_mapping(batch, mappings(batch.sparkSession)), batch_id)

    writer = events.writeStream.outputMode("append").foreachBatch(publish)
    return _start(writer, name, checkpoint, trigger or {"processingTime": "60 seconds"})


def dedup_query(
    messages: DataFrame,
    sink: Sink,
    checkpoint: str,
    event_time: str,
    delay: str,
    value: str = "value",
    name: str = "dedup",
    trigger: Mapping[str, Any] | None = None,
) -> StreamingQuery:
    """Publish each message of a stream once within ``delay`` of event time; state holds a hash per message so long."""
    once = deduplicate(messages, value, event_time, delay)
    writer = once.writeStream.outputMode("append").foreachBatch(sink)
    return _start(writer, name, checkpoint, trigger or {"processingTime": "60 seconds"})
