"""The log envelope: content id, tags, event and ingest times, row id, source, tenant."""

from pyspark.sql import functions as F

from logweir.functions import content_id, dense_guid, minute_stamp, numeric_stamp, stable_guid
from logweir.operators.sequence import NINE_DIGITS, nine_digit_sequence

SEQUENCE = "_sequence"


def _guid(guid, content, time):
    if guid == "stable":
        return stable_guid(content)
    if guid in ("dense", "numbered"):
        return dense_guid(minute_stamp(time), F.col(SEQUENCE))
    raise ValueError(f"unknown row id: {guid}")


def with_dense_guid(df, time="MetadataLogTimeGenerated", stored=None):
    """The rows with dense ids in place of the ones they have. `stored` are rows that have dense
    ids already; theirs are not given again."""
    taken = None
    if stored is not None:
        place = F.col("MetadataLogGuid") % NINE_DIGITS + 1
        minute = F.expr(f"MetadataLogGuid DIV {NINE_DIGITS}L").alias("group")
        taken = stored.groupBy(minute).agg(F.max(place).alias("next"))
    columns = df.columns
    minute = minute_stamp(F.col(time))
    numbered = nine_digit_sequence(df, SEQUENCE, minute, taken)
    guid = dense_guid(minute, F.col(SEQUENCE))
    return numbered.withColumn("MetadataLogGuid", guid).select(*columns)


def envelope(
    df,
    *,
    time,
    source,
    tenant,
    log_type,
    table_type,
    now=None,
    id_columns=None,
    bits=512,
    with_id=True,
    guid="stable",
):
    """Payload columns followed by the envelope, in one projection.

    `time` and `source` name the event-time and source columns; both move into the envelope.
    `id_columns` are hashed for the content id (default: all columns, in order). `guid` is
    "stable" (hash of the content id, the same in every run, allowed on streams) or "dense"
    (event minute and a nine-digit number within it, batch only). Without `with_id` the
    envelope has neither id. `now` is the ingest time.
    """
    now = F.current_timestamp() if now is None else now
    payload = [name for name in df.columns if name not in (time, source)]
    content = content_id(id_columns or df.columns, bits)
    if with_id and guid == "dense":
        df = nine_digit_sequence(df, SEQUENCE, minute_stamp(F.col(time)))
    columns = [
        *payload,
        F.lit(log_type).alias("MetadataLogType"),
        F.col(time).alias("MetadataLogTimeGenerated"),
        numeric_stamp(F.col(time)).alias("MetadataLogDate"),
        now.cast("string").alias("TimeGenerated"),
        F.col(source).alias("MetadataLogFileName"),
        F.lit(tenant).alias("TenantId"),
        F.lit(table_type).alias("Type"),
    ]
    if with_id:
        columns.insert(len(payload), content.alias("MetadataLogId"))
        row_id = _guid(guid, content, F.col(time)).alias("MetadataLogGuid")
        columns.insert(len(payload) + 5, row_id)
    return df.select(*columns)


def add_identity(df, time="MetadataLogTimeGenerated", id_columns=None, bits=512, guid="stable"):
    """All columns, then the content id over them and the row id. With `guid="numbered"` the rows
    have their number within the minute already, in the column SEQUENCE, which goes."""
    columns = [name for name in df.columns if name != SEQUENCE]
    content = content_id(id_columns or columns, bits)
    if guid == "dense":
        df = nine_digit_sequence(df, SEQUENCE, minute_stamp(F.col(time)))
    return df.select(
        *columns,
        content.alias("MetadataLogId"),
        _guid(guid, content, F.col(time)).alias("MetadataLogGuid"),
    )
