"""Batch and streaming outputs."""

from logweir.sinks.buckets import upsert_buckets, write_buckets
from logweir.sinks.reports import write_lines
from logweir.sinks.streams import stream_append
from logweir.sinks.tables import append_table, replace_table, upsert_table, write_run

__all__ = [
    "append_table",
    "replace_table",
    "stream_append",
    "upsert_buckets",
    "upsert_table",
    "write_buckets",
    "write_lines",
    "write_run",
]
