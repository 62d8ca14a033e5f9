"""DataFrame to DataFrame operators."""

from logweir.operators.changes import changed_keys
from logweir.operators.enrich import enrich_usage, repeated_keys
from logweir.operators.envelope import add_identity, envelope
from logweir.operators.parse import parse_messages, parse_query_log, split_malformed
from logweir.operators.pricing import first_rows, newest_page, price_status
from logweir.operators.reconcile import day_checksums, differing_days, reconcile
from logweir.operators.sequence import dense_sequence, nine_digit_sequence
from logweir.operators.upsert import latest_per_key, upsert
from logweir.operators.validate import preview_layers, validate_layers
from logweir.operators.watermark import latest_checkpoint, next_checkpoint, since, unseen

__all__ = [
    "add_identity",
    "changed_keys",
    "day_checksums",
    "dense_sequence",
    "differing_days",
    "enrich_usage",
    "envelope",
    "first_rows",
    "latest_checkpoint",
    "latest_per_key",
    "newest_page",
    "next_checkpoint",
    "nine_digit_sequence",
    "parse_messages",
    "parse_query_log",
    "preview_layers",
    "price_status",
    "reconcile",
    "repeated_keys",
    "since",
    "split_malformed",
    "unseen",
    "upsert",
    "validate_layers",
]
