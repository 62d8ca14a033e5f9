"""Capture the metadata messages there are now and upsert them by ontology."""

from dataclasses import dataclass, field

from pyspark.sql import functions as F

from logweir.fixed_values import METADATA_FIELDS, METADATA_LOG_TYPE, METADATA_TABLE_TYPE
from logweir.operators.envelope import envelope, with_dense_guid
from logweir.operators.parse import parse_messages
from logweir.schemas import METADATA_EVENT, METADATA_GOLD
from logweir.session import pin_utc
from logweir.sinks.buckets import upsert_buckets
from logweir.sinks.streams import default_checkpoint
from logweir.sinks.tables import upsert_table, write_run
from logweir.sources.messages import BODY, capture_available, capture_for
from logweir.sources.tables import read_table, table_exists


@dataclass(frozen=True)
class MetadataJob:
    """Where metadata goes and how it is tagged.

    `order_by` names message columns that say which of two messages is newer, such as an offset.
    `full_body` hashes arrival time and source label along with the payload, so that the same
    message captured twice has two content ids; without it the id depends on the payload only.
    With `buckets`, a new table is dealt into so many by ontology, and a capture reads and rewrites
    only those that it has ontologies for.
    """

    table: str
    tenant: str
    label: str
    quarantine: str = None
    checkpoint: str = None
    order_by: list = field(default_factory=list)
    full_body: bool = False
    guid: str = "stable"
    bits: int = 512
    fmt: str = "parquet"
    buckets: int = 0


def metadata_rows(messages, job, now=None, stored=None):
    """Well-formed and malformed rows of a batch: (enveloped rows with the order columns, bad).
    Dense ids go on after those of the `stored` rows."""
    now = F.current_timestamp() if now is None else now
    order = [F.col(name).alias(f"_order_{name}") for name in job.order_by]
    parsed = parse_messages(messages, METADATA_EVENT, keep=order)
    good = (
        parsed.where(~F.col("malformed"))
        .drop("malformed", BODY)
        .withColumns({"TimeGenerated": now, "input_file_path": F.lit(job.label)})
    )
    payload = METADATA_FIELDS
    hashed = [*payload, "TimeGenerated", "input_file_path"] if job.full_body else payload
    rows = envelope(
        good,
        time="TimeGenerated",
        source="input_file_path",
        tenant=job.tenant,
        log_type=METADATA_LOG_TYPE,
        table_type=METADATA_TABLE_TYPE,
        now=now,
        id_columns=hashed,
        bits=job.bits,
    )
    if job.guid == "dense":
        rows = with_dense_guid(rows, stored=stored)
    bad = parsed.where("malformed").select(BODY, now.alias("TimeGenerated"))
    return rows, bad


def store_metadata(rows, job, token=None):
    """Upsert rows by ontology into the job's table; `token` names their batch."""
    order = [f"_order_{name}" for name in job.order_by if f"_order_{name}" in rows.columns]
    settings = {"keys": ["ontology"], "order_by": order, "columns": METADATA_GOLD.names, "token": token}
    if job.buckets:
        upsert_buckets(rows, job.table, n_buckets=job.buckets, **settings)
    else:
        upsert_table(rows, job.table, fmt=job.fmt, **settings)


def run_metadata_upsert(stream, job, seconds=None):
    """Take everything the stream holds now into the metadata table, then stop; returns the ended
    query. With `seconds`, stop after the batch that is in hand then, and return whether everything
    was taken; the next call goes on where this one ended.

    The batch is kept for its two outputs. Its name marks what is written, so a batch that comes
    again after a failure replaces its own quarantine rows and leaves the table as it is when it
    was already in.
    """
    if job.buckets and job.fmt != "parquet":
        raise ValueError("only a parquet table is dealt into buckets")
    pin_utc(stream.sparkSession)
    checkpoint = job.checkpoint or default_checkpoint(job.table)

    def take(batch, name):
        spark, stored = batch.sparkSession, None
        if job.guid == "dense" and table_exists(spark, job.table, job.fmt):
            stored = read_table(spark, job.table, job.fmt, METADATA_GOLD)
        rows, bad = metadata_rows(batch.persist(), job, stored=stored)
        try:
            if job.quarantine and not bad.isEmpty():
                write_run(bad, job.quarantine, name, job.fmt)
            if not rows.isEmpty():
                store_metadata(rows, job, name)
        finally:
            batch.unpersist()

    if seconds is None:
        return capture_available(stream, take, checkpoint)
    return capture_for(stream, take, checkpoint, seconds)
