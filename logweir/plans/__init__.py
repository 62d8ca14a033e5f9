"""Whole jobs: sources, operators and sinks wired together."""

from logweir.plans.metadata import MetadataJob, run_metadata_upsert, store_metadata
from logweir.plans.price_watch import run_price_watch
from logweir.plans.query_log import (
    QueryLogJob,
    RunResult,
    run_query_log_etl,
    run_query_log_stream,
)
from logweir.plans.usage import (
    correct_usage_gold,
    read_usage_gold,
    run_usage_bronze,
    run_usage_bronze_split,
    run_usage_gold,
    run_usage_gold_stream,
    run_usage_silver,
)

__all__ = [
    "MetadataJob",
    "QueryLogJob",
    "RunResult",
    "correct_usage_gold",
    "read_usage_gold",
    "run_metadata_upsert",
    "run_price_watch",
    "run_query_log_etl",
    "run_query_log_stream",
    "run_usage_bronze",
    "run_usage_bronze_split",
    "run_usage_gold",
    "run_usage_gold_stream",
    "run_usage_silver",
    "store_metadata",
]
