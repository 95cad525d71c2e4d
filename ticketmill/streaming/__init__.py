from ticketmill.streaming.queries import (
    start_batches,
    start_checked_table,
    start_enriched_table,
    start_exports,
    start_window_changes,
    start_window_table,
    wait_for,
)
from ticketmill.streaming.state import open_windows

__all__ = [
    "open_windows",
    "start_batches",
    "start_checked_table",
    "start_enriched_table",
    "start_exports",
    "start_window_changes",
    "start_window_table",
    "wait_for",
]
