"""Operators: ``DataFrame -> DataFrame``."""

from .archive import archive_rows, enrich, storable, to_archive, with_partitions
from .dedup import deduplicate, with_fingerprint
from .mapping import with_mapping
from .metrics import base_ratios, finish, ratio, window_label, window_state, windowed_metrics
from .panes import merge_panes, pane_partials, read_panes, roll_up, write_panes
from .sessions import session_metrics, session_updates
from .shape import evaluate_once
from .validate import (
    observe_rejects,
    reject_codes,
    reject_stats,
    rejected,
    valid,
    valid_events,
    validate,
)

__all__ = [
    "archive_rows", "base_ratios", "deduplicate", "enrich", "evaluate_once", "finish",
    "merge_panes", "observe_rejects", "pane_partials", "ratio", "read_panes", "reject_codes", "reject_stats", "rejected",
    "roll_up", "session_metrics", "session_updates", "storable", "to_archive", "valid", "valid_events", "validate", "window_label", "window_state",
    "windowed_metrics", "with_fingerprint", "with_mapping", "with_partitions", "write_panes",
]
