"""Row transforms between layers. The same functions serve a batch frame and a stream."""

from pyspark.sql import functions as F

from logweir.fixed_values import METADATA_LOG_TYPE, METADATA_TABLE_TYPE, USAGE_FIELDS
from logweir.functions import content_id
from logweir.operators.enrich import enrich_usage
from logweir.operators.envelope import add_identity, envelope
from logweir.operators.parse import parse_messages
from logweir.schemas import USAGE_EVENT
from logweir.sources.messages import BODY
from logweir.streaming.once import once


def _now(now):
    return F.current_timestamp() if now is None else now


def bronze_columns(label, schema=USAGE_EVENT, now=None, rest=None):
    stamp = [_now(now).alias("TimeGenerated"), F.lit(label).alias("input_file_path")]
    return [*schema.names, *stamp, *([rest] if rest else [])]


def malformed_columns(now=None):
    return [BODY, _now(now).alias("TimeGenerated")]


def message_content(schema=USAGE_EVENT):
    """What tells a parsed message from others: its fields, or its body where that is malformed."""
    body = F.sha2(F.coalesce(F.col(BODY), F.lit(b"")), 256)
    return F.when(F.col("malformed"), body).otherwise(content_id(schema.names, 256))


def parsed_messages(messages, *, schema=USAGE_EVENT, once_within=None, arrived=None, rest=None):
    """Fields, body and `malformed` of a stream's messages; with `once_within`, such as "1 hour",
    without those delivered again within that time of arrival."""
    parsed = parse_messages(messages, schema, keep=[arrived] if arrived else [], rest=rest)
    if once_within:
        parsed = once(parsed, message_content(schema), arrived, once_within)
    return parsed


def bronze_rows(
    messages, label, *, schema=USAGE_EVENT, now=None, keep_malformed=False, once_within=None,
    arrived=None, rest=None,
):
    """Parsed messages with their arrival time and source label.

    Malformed messages are left to `malformed_rows`; with `keep_malformed` they stay here as rows
    of NULL fields. `rest` names a VARIANT column for what the schema does not know.
    """
    parsed = parsed_messages(
        messages, schema=schema, once_within=once_within, arrived=arrived, rest=rest
    )
    if not keep_malformed:
        parsed = parsed.where(~F.col("malformed"))
    return parsed.select(*bronze_columns(label, schema, now, rest))


def malformed_rows(messages, *, schema=USAGE_EVENT, now=None, once_within=None, arrived=None):
    """The messages `bronze_rows` leaves out, as they came."""
    parsed = parsed_messages(messages, schema=schema, once_within=once_within, arrived=arrived)
    return parsed.where("malformed").select(*malformed_columns(now))


def silver_rows(
    bronze, tenant, *, log_type=METADATA_LOG_TYPE, table_type=METADATA_TABLE_TYPE, now=None
):
    """Bronze rows in the log envelope, without ids."""
    return envelope(
        bronze,
        time="TimeGenerated",
        source="input_file_path",
        tenant=tenant,
        log_type=log_type,
        table_type=table_type,
        now=now,
        with_id=False,
    )


def gold_rows(silver, metadata, *, bits=512, guid="stable", dedupe=False, **enrich):
    """Silver rows with ids and, for file events, the file's metadata.

    `dedupe` keeps one row per event, for sources that deliver an event more than once. It
    compares the event's own fields, so it also merges equal events of one minute.
    """
    if dedupe:
        silver = silver.dropDuplicates(USAGE_FIELDS)
    return enrich_usage(add_identity(silver, bits=bits, guid=guid), metadata, **enrich)
