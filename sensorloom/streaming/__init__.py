"""Structured Streaming: sources, sinks, control, and ingestion that adapts its schema."""

from sensorloom.streaming.changes import (
    RuleLog, change_stream, follow, keep_latest, label_refreshed, latest, latest_rows, merge_counts, new_rows_only,
    rule_report, signed_counts,
)
from sensorloom.streaming.evolve import read_evolved, run_evolving
from sensorloom.streaming.readers import connect, file_stream, message_stream, table_stream
from sensorloom.streaming.writers import (
    configure, copy_into, latest_result, merge_updates, rewrite_each_batch, stop_all, to_memory, to_path,
    to_table,
)

__all__ = [
    "RuleLog", "change_stream", "configure", "connect", "copy_into", "file_stream", "follow", "keep_latest",
    "label_refreshed", "latest", "latest_result", "latest_rows", "merge_counts", "merge_updates", "message_stream",
    "new_rows_only", "read_evolved", "rewrite_each_batch", "rule_report", "run_evolving", "signed_counts", "stop_all",
    "table_stream", "to_memory", "to_path", "to_table",
]
