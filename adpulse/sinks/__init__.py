"""Where results go: Kafka topics, files per micro-batch, the hourly archive."""

from .files import batch_files, read_batches, read_latest, write_archive
from .kafka import kafka_dead_letters, kafka_metrics, sink_options

__all__ = [
    "batch_files", "kafka_dead_letters", "kafka_metrics", "read_batches", "read_latest", "sink_options", "write_archive",
]
