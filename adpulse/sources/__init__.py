"""Where events come from: Kafka, JSON files, the archive, and the JSON decoder."""

from .codec import (
    decode,
    decode_mixed,
    decode_with_errors,
    encode_base_metrics,
    encode_events,
    encode_metrics,
    event_json,
    nest_metrics,
    observe_decode,
    parse_instant,
    split_mixed,
    wire_schema,
)
from .files import archive_schema, read_archive, read_json_lines
from .kafka import read_topic, source_options

__all__ = [
    "archive_schema", "decode", "decode_mixed", "decode_with_errors", "encode_base_metrics",
    "encode_events", "encode_metrics", "event_json", "nest_metrics", "observe_decode",
    "parse_instant", "read_archive", "read_json_lines", "read_topic", "source_options",
    "split_mixed", "wire_schema",
]
