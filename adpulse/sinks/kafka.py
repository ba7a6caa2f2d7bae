"""Kafka sinks. They need the ``spark-sql-kafka-0-10`` package on the cluster.

Delivery is at least once: consumers upsert on window type, window start and key.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from ..config import Settings
from ..sources.codec import encode_events, encode_metrics


def sink_options(settings: Settings, topic: str) -> dict[str, str]:
    """Writer options for a topic."""
    return {**settings.kafka_options(), "topic": topic}


def kafka_metrics(settings: Settings, side: str) -> Callable[[DataFrame, int], None]:
    """Write finished metric rows as JSON; tumbling and sliding rows share the topic of the side."""
    options = sink_options(settings, settings.metrics_topic(side))

    def write(metrics: DataFrame, batch_id: int) -> None:
        encode_metrics(metrics).write.format("kafka").options(**options).save()

    return write


def kafka_dead_letters(settings: Settings, side: str) -> Callable[[DataFrame, int], None]:
    """Write rejected events as bare JSON, without the reason; both sides share one topic."""
    options = sink_options(settings, settings.dead_letter_topic)

    def write(letters: DataFrame, batch_id: int) -> None:
        encode_events(letters, side).write.format("kafka").options(**options).save()

    return write
