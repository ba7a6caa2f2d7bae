"""Structured Streaming: the queries and the jobs made of them."""

from .jobs import Edges, checkpoint_root, kafka_edges, start
from .panes import panes_query
from .queries import archive_query, dead_letter_query, dedup_query, mapping_query, metrics_query, session_query

__all__ = [
    "Edges", "archive_query", "checkpoint_root", "dead_letter_query", "dedup_query", "kafka_edges", "mapping_query", "metrics_query",
    "panes_query", "session_query", "start",
]
