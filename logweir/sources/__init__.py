"""Batch and streaming inputs."""

from logweir.sources.buckets import read_buckets
from logweir.sources.files import candidate_files, existing_paths, read_json_logs
from logweir.sources.messages import capture_available, capture_for, stream_messages
from logweir.sources.tables import (
    read_table,
    read_watchlist,
    rows_table,
    stream_table,
    table_exists,
)

__all__ = [
    "candidate_files",
    "capture_available",
    "capture_for",
    "existing_paths",
    "read_buckets",
    "read_json_logs",
    "read_table",
    "read_watchlist",
    "rows_table",
    "stream_messages",
    "stream_table",
    "table_exists",
]
