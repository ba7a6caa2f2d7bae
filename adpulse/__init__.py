"""Advertising event metrics on Spark: decode, validate, aggregate by window, archive."""

from .config import Settings
from .operators import (
    deduplicate,
    reject_stats,
    rejected,
    to_archive,
    valid,
    valid_events,
    validate,
    windowed_metrics,
    with_mapping,
)
from .schemas import DSP, SSP
from .session import configure
from .sources import decode, decode_mixed, encode_events, encode_metrics, read_archive
from .streaming import start

__all__ = [
    "DSP", "SSP", "Settings", "configure", "decode", "decode_mixed", "deduplicate", "encode_events",
    "encode_metrics", "read_archive", "reject_stats", "rejected", "start", "to_archive", "valid",
    "valid_events", "validate", "windowed_metrics", "with_mapping",
]
