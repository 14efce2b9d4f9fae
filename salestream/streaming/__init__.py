"""Streaming queries over windowed sales and a table view of their progress."""

from salestream.streaming.late import late_watermark, read_late, start_update_log_with_late
from salestream.streaming.progress import (
    observed,
    observed_totals,
    progress_log,
    progress_table,
    record_progress,
)
from salestream.streaming.queries import (
    STATE_STORE_CONF,
    start_delta_append,
    start_document_append,
    start_final_windows,
    start_rejects,
    start_update_log,
    use_state_store,
)

__all__ = [
    "STATE_STORE_CONF", "late_watermark", "observed", "observed_totals", "progress_log", "progress_table", "read_late",
    "record_progress", "start_delta_append", "start_document_append", "start_final_windows", "start_rejects",
    "start_update_log", "start_update_log_with_late", "use_state_store",
]
