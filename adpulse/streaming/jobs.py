"""The four jobs: aggregation and storage for each side."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..config import Settings
from ..schemas import Side, side_of
from ..session import configure
from ..sinks import kafka_dead_letters, kafka_metrics
from ..sources import decode_with_errors, observe_decode, read_topic
from ..sources.kafka import INGEST_TIME, PARTITION
from .panes import panes_query
from .queries import AsOf, Sink, archive_query

MODES = ("aggregation", "storage", "all")
IDLE_MS = 30_000  # fixed value: a partition without news for so long holds no watermark


@dataclass(frozen=True)
class Edges:
    """Where a job reads and writes. The default is Kafka; tests and backfills use files.

    ``events(storage)`` gives a stream of decoded events; ``as_of`` is the "now" of validation. ``late`` gets events that
    came after their windows, ``source`` tells the partitions of a topic apart.
    """

    events: Callable[[bool], DataFrame]
    metrics: Sink
    dead_letters: Sink
    as_of: AsOf = None
    late: Sink | None = None
    source: Column | None = None


def kafka_edges(spark: SparkSession, settings: Settings, side: str | Side) -> Edges:
    """Read the topic of the side, write its metrics topic and the dead letter topic.

    Events are judged against the broker's ingest time, so aggregation and archive judge an event alike. Messages that
    are no events are dropped and counted, as the observed metric ``decode``.
    """
    side = side_of(side)

    def events(storage: bool) -> DataFrame:
        messages = decode_with_errors(read_topic(spark, settings, side, storage), side)
        return observe_decode(messages).where("decode_error IS NULL").drop("decode_error", "value")

    return Edges(
        events=events,
        metrics=kafka_metrics(settings, side.name),
        dead_letters=kafka_dead_letters(settings, side.name),
        as_of=F.col(INGEST_TIME),
        source=F.col(PARTITION),
    )


def checkpoint_root(spark: SparkSession, settings: Settings) -> str:
    """Where the queries keep offsets and state: the setting, else the cluster's checkpoint folder,
    else a folder next to the archive."""
    return (
        settings.checkpoint_path
        or spark.conf.get("spark.checkpoint.dir", None)
        or f"{settings.output_root}/_checkpoints"
    ).rstrip("/")


def start(
    spark: SparkSession,
    side: str | Side,
    settings: Settings,
    mode: str | None = None,
    edges: Edges | None = None,
    trigger: Mapping[str, Any] | None = None,
) -> list[StreamingQuery]:
    """Start the queries of a side: ``aggregation`` (dead letters, tumbling and sliding windows), ``storage``
    (archive) or ``all``.

    Aggregation reads, decodes and validates the topic once, for all its outputs. The archive is a query of its own,
    so that its progress is independent. Each has its own checkpoint and a trigger of one checkpoint interval. After a
    restart it resumes from there; late rows, panes and offsets are kept exactly once, files of the archive too,
    Kafka output at least once.
    """
    side = side_of(side)
    mode = mode or settings.job_mode
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode!r}: expected one of {', '.join(MODES)}")
    configure(spark)
    if settings.default_parallelism:
        spark.conf.set("spark.sql.shuffle.partitions", str(settings.default_parallelism))
    edges = edges or kafka_edges(spark, settings, side)
    trigger = trigger or {"processingTime": f"{settings.checkpoint_interval_ms} milliseconds"}
    root = f"{checkpoint_root(spark, settings)}/{side.name}"
    started = []
    if mode in ("aggregation", "all"):
        name = f"{side.name}_windows"
        started.append(panes_query(
            edges.events(False), side, edges.metrics, f"{root}/{name}", name,
            ((settings.tumbling_size_ms, None), (settings.sliding_size_ms, settings.sliding_slide_ms)),
            delay_ms=settings.allowed_lateness_ms, lateness_ms=settings.allowed_lateness_ms,
            dead_letters=edges.dead_letters, late=edges.late, source=edges.source,
            policy="max" if edges.source is None else "min", idle_ms=IDLE_MS, as_of=edges.as_of, trigger=trigger,
        ))
    if mode in ("storage", "all"):
        name = f"{side.name}_archive"
        started.append(archive_query(
            edges.events(True), side, settings.archive_path(side.name), f"{root}/{name}", name,
            settings.partition_by, options=settings.parquet_options(), trigger=trigger,
        ))
    return started
