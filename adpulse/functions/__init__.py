"""Scalar functions: ``Column -> Column``, all built from Spark SQL expressions."""

from .actions import is_action_of, parse_action
from .fingerprint import envelope, fingerprint
from .text import is_blank
from .time import (
    current_hour_start_ms,
    current_minute_start_ms,
    from_epoch_millis,
    iso_instant,
    partition_columns,
    partition_path,
    truncate_to_day,
    truncate_to_hour,
    truncate_to_minute,
    truncate_to_n_minutes,
    within_processing_window,
)

__all__ = [
    "current_hour_start_ms", "current_minute_start_ms", "envelope", "fingerprint", "from_epoch_millis",
    "is_action_of", "is_blank", "iso_instant", "parse_action",
    "partition_columns", "partition_path", "truncate_to_day", "truncate_to_hour",
    "truncate_to_minute", "truncate_to_n_minutes", "within_processing_window",
]
